"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written


def components(spark: SparkSession, links: DataFrame, name: str) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b of one type):
    root is the least node of the node's component.

    Alternating large-star and small-star rounds (Kiveris et al., 2014) turn the
    links into stars around the least node. A node only ever needs the minimum of
    its neighbours, a partial aggregate, so a hub is never collected; a hub's
    rows in the join can be split. Every round is written out and read back, so
    the lineage stays short and lost executors repeat one round at most.
    """
    links = written(spark, links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _all_stars(links):
        links = written(spark, _small_star(_large_star(links)), name)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _all_stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller node, or only links to larger ones."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        links.select("b", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 or (up = 1 and down = 1)").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbourhood."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of these
    (``links`` point from the larger to the smaller node)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
