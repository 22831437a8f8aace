"""Feature-table shapes and column-level preparation.

Two shapes are used everywhere:

* wide  - one row per record, one column per feature, or one array column;
* long  - ``(id, label, dim, x)``, produced by ``posexplode`` inside the scan
  stage. Every statistic is a ``groupBy`` over the long form, so the plan is
  one partial aggregate per task and a shuffle of at most dims (x labels)
  rows per task, whatever the row count.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def feature_columns(columns: Sequence[str], label: str | None = "label",
                    pattern: str = r"\d+") -> list[str]:
    """B1: every non-label column, ordered by the integer in its name (none -> 0).

    Python's sort is stable, so names with equal numbers keep schema order.
    """
    rx = re.compile(pattern)

    def key(name: str) -> int:
        m = rx.search(name)
        return int(m.group(m.lastindex or 0)) if m else 0

    return sorted((c for c in columns if c != label), key=key)


def vector_to_long(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id",
                   label_col: str | None = "label") -> DataFrame:
    """Array column -> ``(id, [label,] dim, x)`` with ``x`` as double."""
    keep = [id_col] + ([label_col] if label_col else [])
    return (df.select(*keep, F.posexplode(vector_col).alias("dim", "x"))
              .withColumn("x", F.col("x").cast("double")))


def wide_to_long(df: DataFrame, feature_cols: Sequence[str], id_col: str,
                 label_col: str | None = None) -> DataFrame:
    """Wide columns -> long form; ``dim`` is the position in ``feature_cols``.

    Projection happens before the explode, so a Parquet scan reads only the
    listed columns.
    """
    keep = [id_col] + ([label_col] if label_col else [])
    arr = F.array(*[F.col(c).cast("double") for c in feature_cols])
    return df.select(*keep, F.posexplode(arr).alias("dim", "x"))


def dim_names(long_df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Attach the feature name of each ``dim`` (a literal array lookup, no join)."""
    return long_df.withColumn("column", F.element_at(F.array(*[F.lit(n) for n in names]),
                                                     F.col("dim") + 1))


def long_to_wide(long_df: DataFrame, keys: Sequence[str], n_dims: int, value: str = "x",
                 prefix: str = "f") -> DataFrame:
    """Long -> wide with a fixed, known column list (pivot values are given, so
    Spark does not run a distinct job to discover them)."""
    return (long_df.groupBy(*keys)
                   .pivot("dim", list(range(n_dims)))
                   .agg(F.max(value))
                   .select(*keys, *[F.col(str(i)).alias(f"{prefix}{i}") for i in range(n_dims)]))


def grid_position(dim: Column | str, width: int) -> tuple[Column, Column]:
    """Flat index -> (row, col) on a ``width``-wide grid."""
    d = F.col(dim) if isinstance(dim, str) else dim
    return (F.floor(d / width).cast("int").alias("row"), F.pmod(d, F.lit(width)).cast("int").alias("col"))


def empty_ratio(long_df: DataFrame, is_empty: Column | None = None) -> DataFrame:
    """Per ``dim``: rows, empty count and ratio.

    Default "empty" is ``x == 0``; a null is not empty but is counted in the
    denominator (the reference counts nulls as non-zero).
    """
    empty = is_empty if is_empty is not None else (F.col("x") == 0)
    return (long_df.groupBy("dim")
                   .agg(F.count(F.lit(1)).alias("n_rows"),
                        F.sum(F.when(empty, 1).otherwise(0)).cast("bigint").alias("n_empty"))
                   .withColumn("empty_ratio", F.col("n_empty") / F.col("n_rows")))


def select_informative(long_df: DataFrame, threshold: float = 0.98,
                       is_empty: Column | None = None) -> DataFrame:
    """Keep a column when its empty ratio is strictly below ``threshold``.

    Returns ``(dim, n_rows, n_empty, empty_ratio, keep)``; callers that need the
    kept list collect this table, whose size is the column count. A table with
    no rows has no ``dim`` rows here; ``kept_dims`` then keeps every column.
    """
    return empty_ratio(long_df, is_empty).withColumn("keep", F.col("empty_ratio") < F.lit(threshold))


def kept_dims(selection: DataFrame, n_dims: int) -> list[int]:
    """Driver-side list of kept dims (at most ``n_dims`` small rows)."""
    rows = selection.select("dim", "keep").collect()
    if not rows:
        return list(range(n_dims))
    return sorted(int(r["dim"]) for r in rows if r["keep"])


def fill_nulls(df: DataFrame, value: float | int = 0, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls in numeric columns."""
    return df.na.fill(value, subset=list(subset) if subset else None)


def minmax_scale_long(long_df: DataFrame) -> DataFrame:
    """``(x - min) / (max - min)`` per dim; a constant dim maps to 0.5
    (what MLlib's MinMaxScaler does).

    Bounds come from a partial aggregate (one row per dim), then a broadcast
    hash join: the broadcast side has exactly one row per dim, a bound fixed
    by the schema, not by the data volume. A window partitioned by dim would
    instead put every row of a dim into one task."""
    bounds = long_df.groupBy("dim").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return (long_df.join(F.broadcast(bounds), "dim")
                   .withColumn("scaled", F.when(F.col("hi") == F.col("lo"), F.lit(0.5))
                               .otherwise((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))))
                   .drop("lo", "hi"))


def assemble_array(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """G3 as an array<double> (the vector form is ``array_to_vector`` of this)."""
    return df.withColumn(out, F.array(*[F.col(c).cast("double") for c in cols]))


def minmax_fit(df: DataFrame, vector_col: str) -> tuple[list[float], list[float]]:
    """D19 as a fit: per-position min and max of an array column. One partial
    aggregate; the result (2 x width numbers) is the model, like MLlib's
    MinMaxScalerModel, and is the only thing returned to the driver."""
    long_df = df.select(F.posexplode(vector_col).alias("dim", "x"))
    rows = long_df.groupBy("dim").agg(F.min(F.col("x").cast("double")).alias("lo"),
                                      F.max(F.col("x").cast("double")).alias("hi")).collect()
    rows = sorted(rows, key=lambda r: r["dim"])
    return [r["lo"] for r in rows], [r["hi"] for r in rows]


def minmax_scale_array(df: DataFrame, vector_col: str, lo: Sequence[float], hi: Sequence[float],
                       out: str = "scaled") -> DataFrame:
    """G2 on an array column with fitted bounds: element-wise, in place, no
    shuffle (constant positions map to 0.5)."""
    lo_a = F.array(*[F.lit(float(v)) for v in lo]).cast("array<double>")
    hi_a = F.array(*[F.lit(float(v)) for v in hi]).cast("array<double>")

    def scale(x, i):
        a, b = F.element_at(lo_a, i + 1), F.element_at(hi_a, i + 1)
        return F.when(b == a, F.lit(0.5)).otherwise((x.cast("double") - a) / (b - a))

    return df.withColumn(out, F.transform(vector_col, scale))
