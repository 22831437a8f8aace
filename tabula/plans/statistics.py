"""The statistics run: four tables
computed from the long form, each written once and reused on later runs
unless ``force`` is set. Everything runs on the executors; the only driver
work is the existence check of each table's ``_SUCCESS`` marker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabula.operators import stats
from tabula.sources.tables import materialize


def compute_statistics(spark: SparkSession, long_df: DataFrame, labels: DataFrame, root: str,
                       force: bool = False) -> dict[str, DataFrame]:
    """``long_df`` = (id, label, dim, x); ``labels`` = one row per record with
    a ``label`` column. Returns the four tables, read back from storage."""
    r = root.rstrip("/")
    columns = materialize(spark, stats.column_stats(long_df), f"{r}/column_stats", force)
    return {
        "frequencies": materialize(spark, stats.label_counts(labels), f"{r}/frequencies", force),
        "column_stats": columns,
        "class_means": materialize(spark, stats.class_means(long_df), f"{r}/class_means", force),
        # the stored column statistics hold the deviations already
        "std_map": materialize(spark, columns.select("dim", "std"), f"{r}/std_map", force),
    }
