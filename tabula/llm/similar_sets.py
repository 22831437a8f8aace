"""Exact similarity links among shingle sets that share a MinHash band.

Sets that share a band hash are linked to the least set of that bucket only,
and the components of these links are the candidate groups: every pair that
shares a band lies in one group, without a pair ever being written. A group is
then compared in full: its members are dealt into blocks of about ``BLOCK``,
and each pair of blocks is one task's work, where intersections come from an
inverted list (rare shingles) and a matrix product (common ones). A task gives
back one row per set, with its number of links and its local root, so a group
of n similar sets costs n rows times the blocks, never n squared rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checked_broadcast, lean, written
from .components import components

BLOCK = 1024
RARE = 8


def bucket_links(banded: DataFrame, name: str) -> DataFrame:
    """Links (a, b) from each set to the least set of each of its buckets, for
    ``banded`` rows (set_id, bands)."""
    each = banded.select("set_id", F.explode("bands").alias("h"))
    buckets = each.groupBy("h").agg(F.min("set_id").alias("b"), F.max("set_id").alias("z")).filter("b <> z").drop("z")
    buckets = written(banded.sparkSession, buckets, f"{name}-colliding")
    return each.join(checked_broadcast(buckets, 60), "h").filter("set_id <> b").select(F.col("set_id").alias("a"), "b")


def similar_sets(spark: SparkSession, sets: DataFrame, shingles_of: Callable[[DataFrame], DataFrame],
                 numerator: int, denominator: int, name: str) -> DataFrame:
    """``set_id, root, links`` for each set that has a link.

    ``sets`` has one row per distinct set: set_id, copies, bands and whatever
    ``shingles_of`` needs to give (set_id, shingles) for the members of candidate
    groups. ``links`` counts the copies of all other sets of Jaccard similarity
    numerator/denominator or more; ``root`` is the least set of its component.
    """
    kind = sets.schema["set_id"].dataType.simpleString()
    groups = components(spark, bucket_links(sets, name), f"{name}-buckets")
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = (groups.join(sizes, "root").join(sets.drop("bands").withColumnRenamed("set_id", "node"), "node")
               .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
               .withColumnRenamed("node", "set_id"))
    members = written(spark, members, f"{name}-members")
    whole = members.select("set_id", "copies", "root", "blocks", "block").join(shingles_of(members), "set_id")
    dealt = (whole.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.col("root").alias("grp"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "set_id", "copies", "shingles"))
    compared = (dealt.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
                .mapInArrow(lean(_compare(numerator, denominator)), f"set_id {kind}, root {kind}, links long"))
    compared = written(spark, compared, f"{name}-compared")
    roots = components(spark, compared.select(F.col("set_id").alias("a"), F.col("root").alias("b")), f"{name}-links")
    links = compared.groupBy("set_id").agg(F.sum("links").alias("links"))
    return links.join(roots.withColumnRenamed("node", "set_id"), "set_id")


def _compare(numerator: int, denominator: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def result(key, rows):
            ids, roots, links = compare_group(rows, key[1] != key[2], numerator, denominator)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(roots, kind), pa.array(links, pa.int64())],
                                              ["set_id", "root", "links"])

        key, rows, kind = None, [], None
        for batch in batches:
            kind = batch.schema.field("set_id").type
            sh = batch.column("shingles")
            values, ends = sh.values.to_numpy(zero_copy_only=False).view(np.uint64), sh.offsets.to_numpy()
            plain = [batch.column(c).to_pylist() for c in ("grp", "i", "j", "set_id", "copies", "block")]
            for r, (grp, i, j, one, copies, block) in enumerate(zip(*plain)):
                if key != (grp, i, j):
                    if len(rows) > 1:
                        yield result(key, rows)
                    key, rows = (grp, i, j), []
                rows.append((one, copies, block, values[ends[r]:ends[r + 1]].copy()))
        if len(rows) > 1:
            yield result(key, rows)

    return run


def compare_group(rows, across: bool, numerator: int, denominator: int):
    """Ids, local roots and links of the linked sets among ``rows`` (set_id,
    copies, block, sorted shingles); only pairs of two blocks if ``across``."""
    import numpy as np

    rows = sorted(rows, key=lambda r: r[0])
    n = len(rows)
    size = np.array([len(r[3]) for r in rows], np.float64)
    shared = intersections([r[3] for r in rows])
    linked = shared * (numerator + denominator) >= numerator * (size[:, None] + size[None, :])
    linked &= shared > 0
    np.fill_diagonal(linked, False)
    if across:
        block = np.array([r[2] for r in rows])
        linked &= block[:, None] != block[None, :]
    links = linked @ np.array([r[1] for r in rows], np.float64)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], n).min(1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(links > 0)
    return [rows[i][0] for i in some], [rows[label[i]][0] for i in some], links[some].astype(np.int64)


def intersections(sets):
    """Matrix of the sizes of the intersections of sorted arrays."""
    import numpy as np

    n = len(sets)
    out = np.zeros((n, n), np.float64)
    if n == 2:
        out[0, 1] = out[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return out
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.empty(0, int)
    times = np.diff(np.append(first, len(grams)))
    for k in range(2, RARE + 1):
        at = first[times == k]
        for p in range(k):
            for q in range(p + 1, k):
                np.add.at(out, (owner[at + p], owner[at + q]), 1)
    out += out.T
    common = np.flatnonzero(times > RARE)
    step = 4096
    for c in range(0, len(common), step):
        some = common[c:c + step]
        lens = times[some]
        column = np.repeat(np.arange(len(some)), lens)
        place = np.repeat(first[some] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        has = np.zeros((n, len(some)), np.float32)
        has[owner[place], column] = 1
        out += has @ has.T
    return out
