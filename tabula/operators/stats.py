"""Descriptive and class-conditional statistics.

All of them take the long form ``(id, label, dim, x)`` of ``features`` or a
plain table. Each is one aggregation with map-side partial aggregation, so
the shuffle carries at most (labels x dims) rows per task; nothing is
collected. Class-level tables (labels x dims rows) are the largest outputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators.features import grid_position


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label, ordered by label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(label)


def label_counts_sql(spark: SparkSession, df: DataFrame, view: str = "labelled",
                     label: str = "label") -> DataFrame:
    """D1 through Spark SQL over a temp view (same Catalyst plan as the DataFrame form)."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT {label}, COUNT(*) AS count FROM {view} GROUP BY {label} ORDER BY {label}")


def column_stats(long_df: DataFrame, by: Sequence[str] = ("dim",)) -> DataFrame:
    """Non-null count, mean, sample std, min, max and zero count per
    feature, in one aggregation.

    A null is skipped by the moments and is not a zero. The sample std of a
    single row is NULL (Spark semantics), never an error.
    """
    return (long_df.groupBy(*by)
                   .agg(F.count("x").alias("n"),
                        F.avg("x").alias("mean"),
                        F.stddev_samp("x").alias("std"),
                        F.min("x").alias("min"),
                        F.max("x").alias("max"),
                        F.sum(F.when(F.col("x") == 0, 1).otherwise(0)).cast("bigint").alias("zeros")))


def class_means(long_df: DataFrame, label: str = "label") -> DataFrame:
    """Mean of every feature per class -> ``(label, dim, mean)``."""
    return long_df.groupBy(label, "dim").agg(F.avg("x").alias("mean"))


def std_map(long_df: DataFrame) -> DataFrame:
    """Sample std per feature -> ``(dim, std)``."""
    return long_df.groupBy("dim").agg(F.stddev_samp("x").alias("std"))


def global_means(long_df: DataFrame) -> DataFrame:
    """D8 long form: ``(dim, mean)``."""
    return long_df.groupBy("dim").agg(F.avg("x").alias("mean"))


def global_mean_vector(long_df: DataFrame, expected_dims: int) -> DataFrame:
    """The global means as one ordered array plus a completeness flag.

    The array is built from (dim, mean) pairs sorted by dim; its length is
    the column count. ``complete`` is false when the vector does not have the
    expected length (the reference reports and skips such input).
    """
    pairs = global_means(long_df).agg(F.array_sort(F.collect_list(F.struct("dim", "mean"))).alias("p"))
    return pairs.select(
        F.transform("p", lambda s: s["mean"]).alias("mean_vector"),
        F.size("p").alias("n_dims"),
        (F.size("p") == F.lit(expected_dims)).alias("complete"))


def on_grid(df: DataFrame, width: int, dim: str = "dim") -> DataFrame:
    """Add (row, col) of a flat feature index."""
    row, col = grid_position(dim, width)
    return df.select("*", row, col)


#: Numbers that a block of classes has at most in a task (a block pair holds two).
BLOCK_NUMBERS = 1 << 20
BLOCK_CLASSES = 512


def class_correlation(means: DataFrame, classes: Sequence[int] | None = None, label: str = "label") -> DataFrame:
    """C1 + C3/K5: Pearson r between the mean vectors of every pair of classes,
    over the dims that both have.

    Dense over the classes that occur, or over ``classes`` and those that occur
    besides; a pair with a missing or constant vector is 0.

    Plan: a blocked matrix product. Each class is one row (its dims and means),
    classes are dealt into blocks, and each pair of blocks is one group whose
    sums of products come from matrix products; what is shuffled is a class's row
    once a block, never a row per pair and dim.
    """
    from tabula.session import ship_package

    ship_package(means.sparkSession)
    kind = means.schema[label].dataType.simpleString()
    per_class = means.filter(F.col("mean").isNotNull() & F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(
        F.collect_list(F.struct("dim", F.col("mean").cast("double").alias("mean"))).alias("cells"))
    size = per_class.agg(F.count("*").alias("n"), F.max(F.size("cells")).alias("dims")).first()
    rows_a_block = max(1, min(BLOCK_CLASSES, BLOCK_NUMBERS // max(1, size["dims"] or 1)))
    blocks = max(1, -(-size["n"] // rows_a_block))
    dealt = (per_class.select("label", F.col("cells.dim").cast("array<long>").alias("dims"), F.col("cells.mean").alias("means"),
                              F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int").alias("block"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "label", "dims", "means"))
    both = dealt.groupBy("i", "j").applyInArrow(_correlated, f"label_a {kind}, label_b {kind}, r double")
    if classes is None:
        return both
    listed = F.array(*[F.lit(c) for c in classes])
    grid = (means.sparkSession.range(1).select(F.explode(listed).alias("label_a"))
            .select("label_a", F.explode(listed).alias("label_b")))
    return (grid.join(both, ["label_a", "label_b"], "full_outer")
            .select("label_a", "label_b", F.coalesce("r", F.lit(0.0)).alias("r")))


def _correlated(group):
    """All pairs of classes of one block, or those across two, in both orders."""
    import numpy as np
    import pyarrow as pa

    group = group.combine_chunks()
    labels, block = group.column("label"), np.asarray(group.column("block"))
    dims = group.column("dims").combine_chunks()
    sizes = np.asarray(dims.value_lengths())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, place = np.unique(np.asarray(dims.flatten()), return_inverse=True)
    values = np.asarray(group.column("means").combine_chunks().flatten())
    x, has = np.zeros((len(sizes), place.max(initial=-1) + 1)), np.zeros((len(sizes), place.max(initial=-1) + 1))
    x[owner, place], has[owner, place] = values, 1.0
    x = np.where(has > 0, x - (x.sum(1) / np.maximum(sizes, 1))[:, None], 0.0)
    x[[len(set(v)) <= 1 for v in np.split(values, np.cumsum(sizes)[:-1])]] = 0.0  # constant: no variance, whatever rounding says
    n = has @ has.T
    with np.errstate(divide="ignore", invalid="ignore"):
        sums = x @ has.T  # of the row's class over the dims that the column's class has too
        spread = (x * x) @ has.T - sums * sums / n
        r = (x @ x.T - sums * sums.T / n) / np.sqrt(spread * spread.T)
    # too little spread to tell from rounding
    r[~np.isfinite(r) | (spread <= 1e-13 * ((x * x) @ has.T)) | (spread.T <= 1e-13 * ((x * x) @ has.T).T)] = 0.0
    inside = group.column("i")[0].as_py() == group.column("j")[0].as_py()
    one, two = np.nonzero((block[:, None] != block[None, :]) | inside)
    return pa.table({"label_a": labels.take(pa.array(one)), "label_b": labels.take(pa.array(two)), "r": pa.array(r[one, two])})


def class_pair_difference(spark: SparkSession, means: DataFrame,
                          pairs: Sequence[tuple[int, int]] = ((1, 7), (3, 8), (4, 9)),
                          label: str = "label") -> DataFrame:
    """|mean_a - mean_b| per feature for the given class pairs.

    The pairs table comes from the caller (its size is the parameter's
    length), so broadcasting it is safe. Pairs with a missing class produce
    no feature rows; ``class_pair_status`` reports them.
    """
    p = F.broadcast(spark.createDataFrame(list(pairs), "label_a int, label_b int"))
    a = means.select(F.col(label).alias("label_a"), "dim", F.col("mean").alias("mean_a"))
    b = means.select(F.col(label).alias("label_b"), "dim", F.col("mean").alias("mean_b"))
    return (p.join(a, "label_a").join(b, ["label_b", "dim"])
             .select("label_a", "label_b", "dim", "mean_a", "mean_b",
                     F.abs(F.col("mean_a") - F.col("mean_b")).alias("abs_diff")))


def class_pair_status(spark: SparkSession, means: DataFrame,
                      pairs: Sequence[tuple[int, int]] = ((1, 7), (3, 8), (4, 9)),
                      label: str = "label") -> DataFrame:
    """One row per requested pair, saying whether both classes exist."""
    present = means.select(label).distinct()
    p = spark.createDataFrame(list(pairs), "label_a int, label_b int")
    pa = present.select(F.col(label).alias("label_a"), F.lit(True).alias("has_a"))
    pb = present.select(F.col(label).alias("label_b"), F.lit(True).alias("has_b"))
    return (p.join(pa, "label_a", "left").join(pb, "label_b", "left")
             .select("label_a", "label_b",
                     (F.coalesce("has_a", F.lit(False)) & F.coalesce("has_b", F.lit(False))).alias("available")))


def ink_density(df: DataFrame, vector_col: str = "embedding", label: str = "label",
                threshold: float = 0.0) -> DataFrame:
    """Per record the share of features above ``threshold`` and the mean
    value (array higher-order functions, no explode, no per-record shuffle),
    then averaged per class: one partial aggregate, one small shuffle."""
    arr = F.transform(vector_col, lambda v: v.cast("double"))
    n = F.size(vector_col)
    per_row = df.select(
        label,
        F.try_divide(F.size(F.filter(arr, lambda v: v > threshold)).cast("double"), n).alias("ink_ratio"),
        F.try_divide(F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v), n).alias("mean_value"))
    return (per_row.groupBy(label)
                   .agg(F.count(F.lit(1)).alias("n"),
                        F.avg("ink_ratio").alias("avg_ink_ratio"),
                        F.avg("mean_value").alias("avg_mean_value")))
