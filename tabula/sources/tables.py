"""Readers for the driver's parquet tables and typed CSV/Parquet I/O."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.operators.features import feature_columns


class SourceNotFound(FileNotFoundError):
    """A2: the input path does not exist."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem API (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def is_directory(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.getFileStatus(hpath).isDirectory())


def require_path(spark: SparkSession, path: str) -> str:
    """A2: fail early, with a typed error, when the source is missing."""
    if not path_exists(spark, path):
        raise SourceNotFound(f"input not found: {path}")
    return path


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of one driver table; a column list is pushed into the scan."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """A1: header CSV. With a schema there is no inference pass; ``infer=True``
    reproduces the reference's inferSchema (an extra scan of the file)."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", str(bool(infer)).lower()).csv(path)


#: Column of lines that don't fit the header or hold a cell that is no number.
MALFORMED = "_malformed"


def read_labelled_csv(spark: SparkSession, path: str, has_label: bool = True, label: str = "label",
                      schema: T.StructType | str | None = None, pattern: str = r"\d+", keep_malformed: bool = False) -> DataFrame:
    """Typed feature reader.

    Requires ``label`` when asked and orders features by the number in their
    name. The header gives the columns; the lines are then parsed once, straight
    to doubles (no string columns, no casts). A cell that is no number becomes
    null instead of failing the job, a missing one too; with ``keep_malformed`` the
    column ``_malformed`` holds the text of such lines. Blanks around numbers don't
    count, quoted cells do. A file whose header differs is an error.
    """
    require_path(spark, path)
    names = load_csv(spark, path, schema=schema).columns
    if has_label and label not in names:
        raise ValueError(f"missing label column {label!r} in {path}")
    wanted = ([label] if has_label else []) + feature_columns(names, label=label, pattern=pattern)
    typed = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
    reader = spark.read.option("header", "true").option("enforceSchema", "false").option("mode", "PERMISSIVE")
    reader = reader.option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true")
    if keep_malformed:
        # a cell is only looked at where it is asked for, so all of them are
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
        typed, wanted = typed.add(MALFORMED, T.StringType()), [*wanted, MALFORMED]
    return reader.schema(typed).csv(path).select(*[F.col(f"`{c}`") for c in wanted])


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, **options: str) -> int:
    """Write ``df`` and return its row count, using an
    ``Observation`` so the count is taken during the write, not by a second job."""
    from pyspark.sql import Observation

    obs = Observation("write_stats")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    for key, value in options.items():
        writer = writer.option(key, value)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def materialize(spark: SparkSession, df: DataFrame, path: str, force: bool = False,
                fmt: str = "parquet") -> DataFrame:
    """Compute-or-reuse. The newest complete version under ``path`` is
    read unless there is none or ``force`` is set; then ``df`` is published as
    one. Writers of one path don't touch each other's files and readers never see
    half a table (``tabula.sources.versions``). What comes back is read from
    storage, which also cuts the lineage."""
    from tabula.sources import versions

    kept = None if force else versions.read_newest(spark, path, fmt)
    if kept is not None:
        return kept
    version = versions.publish_table(spark, df, path, fmt)
    return spark.read.format(fmt).load(versions.version_path(path, version))


# Typed schemas of the statistics sinks (A15); the reader never infers.
STAT_SCHEMAS = {
    "frequencies": "label int, count bigint",
    "column_stats": "dim int, mean double, std double, min double, max double, zeros bigint",
    "class_means": "label int, dim int, mean double",
    "std_map": "dim int, std double",
    "confusion": "label int, prediction int, count bigint",
    "class_metrics": "label int, precision double, recall double, f1 double",
}


def read_stat_table(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Typed reader for the statistics tables written by this package: the
    newest version of a published table, or else the files at ``path``."""
    from tabula.sources import versions

    schema, version = STAT_SCHEMAS[kind], versions.newest(spark, path)
    path = path if version is None else versions.version_path(path, version)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", "true").csv(path)
    return reader.format(fmt).load(path)


def read_train_test(spark: SparkSession, directory: str, train: str = "train.csv",
                    test: str = "test.csv", label: str = "label") -> tuple[DataFrame, DataFrame]:
    """A5: the labelled train file and the unlabelled test file, both typed."""
    d = directory.rstrip("/")
    return (read_labelled_csv(spark, f"{d}/{train}", True, label),
            read_labelled_csv(spark, f"{d}/{test}", False, label))


def to_arrow_small(df: DataFrame, max_rows: int):
    """A9 re-aimed: hand a *small* result to local code as an Arrow table.
    The size is checked first (``limit(max_rows + 1)``), so an unbounded
    table is refused instead of being pulled through the driver."""
    probe = df.limit(max_rows + 1)
    if probe.count() > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; keep it distributed")
    return probe.toArrow()


def feature_dimension(df: DataFrame, vector_col: str = "features") -> int:
    """Length of the feature vector of the first row; error when empty."""
    from pyspark.ml.functions import vector_to_array

    col = F.col(vector_col)
    if df.schema[vector_col].dataType.typeName() == "vector":
        col = vector_to_array(col)
    first = df.select(F.size(col).alias("n")).head(1)
    if not first:
        raise ValueError("cannot read the feature dimension of an empty table")
    return int(first[0]["n"])


def write_metrics_json(spark: SparkSession, path: str, summary: dict, history: DataFrame | None = None,
                       class_metrics: DataFrame | None = None) -> None:
    """One JSON document with the run summary, the per-epoch history and
    the per-class metrics nested as arrays, put together by Spark."""
    doc = spark.range(1).select(*[F.lit(v).alias(k) for k, v in summary.items()])
    for name, frame in (("history", history), ("class_metrics", class_metrics)):
        if frame is not None:
            rows = frame.agg(F.array_sort(F.collect_list(F.struct(*frame.columns))).alias(name))
            doc = doc.withColumn("_one", F.lit(1)).join(rows.withColumn("_one", F.lit(1)), "_one").drop("_one")
    doc.select(F.to_json(F.struct(*doc.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)
