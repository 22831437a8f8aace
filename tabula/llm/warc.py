"""WARC Merkle fixity audit.

A replica is a table of records: file_no, offset, length and SHA-256. Records
are hashed into ordered offset ranges of ``RANGE_BYTES``, ranges into groups of
``FANOUT``, and so on up to one root per file. The audit compares the roots of
two replicas, then only the children of nodes that differ, level by level, and
at last the records of the ranges that differ.

Every level is one aggregate whose groups are bounded (a range holds at most
``RANGE_BYTES`` / 1 records by offset, a node ``FANOUT`` children); each level is
written out, so the next one and a descent read node rows and not the records again.

Offsets are running sums in three steps, so that a file of any size (all null
page_ids, or one page_id over and over) is laid out by many tasks: equal records
are counted per task that read them, the counts are summed up within one leading
part of the digest, and these sums within the file.

Cases: null urls and texts count as empty; a null page_id belongs to a file of
null number; rows of one page_id are ordered by digest, equal ones one after the other; a file that one replica
lacks differs at its root, and all its records are reported; a record is
"changed" if both replicas have one at its offset, "missing" if only the first
has, "extra" if only the second has; extra columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

RECORDS_PER_FILE = 1000
RANGE_BYTES = 1 << 16
FANOUT = 16
#: Leading digits of a digest that records of one page_id are summed up by.
HEAD_DIGITS = 3


def warc_records(pages: DataFrame, records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """Pages as WARC records in files of ``records_per_file`` page ids: page_id,
    file_no and the record's bytes."""
    body = F.coalesce("html", F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(">\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))
    return pages.select("page_id", F.floor(F.col("page_id") / records_per_file).alias("file_no"),
                        F.encode(record, "utf-8").alias("record"))


def replicas(records: DataFrame, *stored: Column) -> list[DataFrame]:
    """What an audit reads of each copy of some records: page_id, file_no,
    offset, length, digest. ``stored`` are the records' bytes as each copy holds
    them, of equal lengths. Digests are made where the records are read, so
    only they go through the shuffle that lays out the files."""
    names = [f"digest_{k}" for k in range(len(stored))]
    slim = records.select("page_id", "file_no", F.octet_length("record").cast("long").alias("length"),
                          *[F.sha2(c, 256).alias(n) for n, c in zip(names, stored)], F.spark_partition_id().alias("source"))
    # written, so that the source is the row's own whatever is planned later
    runs = written(records.sparkSession, slim.groupBy(*slim.columns).agg(F.count("*").alias("n")), "record-runs")
    runs = runs.withColumn("head", F.substring("digest_0", 1, HEAD_DIGITS)).withColumn("bytes", F.col("n") * F.col("length"))

    def before(window):
        return F.coalesce(F.sum("bytes").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    heads = runs.groupBy("file_no", "page_id", "head").agg(F.sum("bytes").alias("bytes"))
    heads = heads.select("file_no", "page_id", "head", before(Window.partitionBy("file_no").orderBy("page_id", "head")).alias("base"))
    inner = Window.partitionBy("file_no", "page_id", "head").orderBy(*names, "length", "source")
    placed = runs.withColumn("at", before(inner)).alias("r").join(
        heads.alias("h"), [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in ("file_no", "page_id", "head")])
    # spread again by source, so that no task writes all copies of one record
    laid = (placed.select("r.*", "base").repartition("file_no", "page_id", "digest_0", "source")
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
            .withColumn("offset", F.col("base") + F.col("at") + F.col("copy") * F.col("length")))
    return [laid.select("page_id", "file_no", "offset", "length", F.col(n).alias("digest")) for n in names]


def merkle_levels(spark: SparkSession, replica: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Nodes (file_no, idx, hash) of each level, the offset ranges first and the
    roots last."""
    def node(order: str):
        parts = F.array_sort(F.collect_list(F.struct(order, "hash")))
        return F.sha2(F.array_join(F.transform(parts, lambda p: F.concat_ws(":", p[order], p["hash"])), ","), 256).alias("hash")

    leaves = replica.select("file_no", F.floor(F.col("offset") / RANGE_BYTES).alias("idx"), "offset",
                            F.concat_ws(":", "length", "digest").alias("hash"))
    levels = [written(spark, leaves.groupBy("file_no", "idx").agg(node("offset")), f"merkle-{name}-1")]
    for k in range(2, height + 1):
        up = levels[-1].select("file_no", F.floor(F.col("idx") / FANOUT).alias("up"), F.col("idx"), "hash")
        level = up.groupBy("file_no", "up").agg(node("idx")).select("file_no", F.col("up").alias("idx"), "hash")
        levels.append(written(spark, level, f"merkle-{name}-{k}"))
    return levels


def audit(spark: SparkSession, first: DataFrame, second: DataFrame) -> DataFrame:
    """Records that differ: file_no, offset, status, and page_id and length of
    the first replica's record (the second's if the first has none)."""
    first, second = written(spark, first, "replica-1"), written(spark, second, "replica-2")
    last = first.select("offset").unionAll(second.select("offset")).agg(F.max("offset")).first()[0] or 0
    height, top = 1, last // RANGE_BYTES
    while top:
        height, top = height + 1, top // FANOUT
    a, b = (merkle_levels(spark, r, height, n) for r, n in ((first, "1"), (second, "2")))

    def differing(level: int, parents: DataFrame | None) -> DataFrame:
        sides = []
        for tree, h in ((a, "ha"), (b, "hb")):
            nodes = tree[level - 1].withColumnRenamed("hash", h)
            if parents is not None:
                up = nodes.withColumn("up", F.floor(F.col("idx") / FANOUT))
                nodes = up.join(parents, up["file_no"].eqNullSafe(parents["pf"]) & (up["up"] == parents["pi"]), "left_semi").drop("up")
            sides.append(nodes)
        x, y = sides[0].alias("x"), sides[1].alias("y")
        both = x.join(y, F.col("x.file_no").eqNullSafe(F.col("y.file_no")) & (F.col("x.idx") == F.col("y.idx")), "full_outer")
        return both.filter(~F.col("ha").eqNullSafe(F.col("hb"))).select(
            F.coalesce("x.file_no", "y.file_no").alias("pf"), F.coalesce("x.idx", "y.idx").alias("pi"))

    nodes = None
    for level in range(height, 0, -1):
        nodes = written(spark, differing(level, nodes), f"merkle-differing-{level}")

    def inside(replica: DataFrame) -> DataFrame:
        at = replica.withColumn("rng", F.floor(F.col("offset") / RANGE_BYTES))
        return at.join(nodes, at["file_no"].eqNullSafe(nodes["pf"]) & (at["rng"] == nodes["pi"]), "left_semi").drop("rng")

    x, y = inside(first).alias("x"), inside(second).alias("y")
    both = x.join(y, F.col("x.file_no").eqNullSafe(F.col("y.file_no")) & (F.col("x.offset") == F.col("y.offset")), "full_outer")
    same = F.col("x.digest").eqNullSafe(F.col("y.digest")) & F.col("x.length").eqNullSafe(F.col("y.length"))
    status = F.when(F.col("y.digest").isNull(), "missing").when(F.col("x.digest").isNull(), "extra").otherwise("changed")
    value = lambda c: F.when(F.col("x.digest").isNotNull(), F.col(f"x.{c}")).otherwise(F.col(f"y.{c}")).alias(c)
    return both.filter(~same).select(value("page_id"), value("file_no"), value("offset"), value("length"), status.alias("status"))


def rotten(record: str = "record") -> Column:
    """The record with bit rot: the last byte before the closing line breaks of
    every 97th page's record is another one."""
    at = F.octet_length(record) - 4
    byte = F.expr(f"substring({record}, octet_length({record}) - 4, 1)")
    rot = F.overlay(record, F.when(byte == F.lit(b"~"), F.lit(b"!")).otherwise(F.lit(b"~")), at, F.lit(1))
    return F.when(F.col("page_id") % 97 == 5, rot).otherwise(F.col(record))


def op6_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' archive audited against the damaged replica."""
    whole, damaged = replicas(warc_records(table(spark, sf_dir, "pages")), F.col("record"), rotten())
    return audit(spark, whole, damaged)


OP6_SQL = f"""
WITH r AS (
  SELECT page_id, CAST(floor(page_id / {RECORDS_PER_FILE}) AS BIGINT) AS file_no,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10) || 'Content-Length: '
         || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
         || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
o AS (
  SELECT page_id, file_no, strlen(record) AS length,
         coalesce(sum(strlen(record)) OVER (PARTITION BY file_no ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS "offset"
  FROM r)
SELECT page_id, file_no, CAST("offset" AS BIGINT) AS "offset", length, 'changed' AS status FROM o
WHERE page_id % 97 = 5
"""
