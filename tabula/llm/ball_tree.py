"""Exact top-k inner products by ball trees, one per shard.

Vectors become integers. Of equal vectors only the ``k + 1`` first by vec_id can
be in any answer (one more than asked, as a query's own row doesn't count), so
a vector that a third of all rows share is cut down before anything moves, and
equal queries are searched once. The rest are dealt evenly into shards of about
``SHARD_NUMBERS`` components; each shard's rows become one ball tree, kept as one
binary row.

A query visits a tree best first: no vector in a ball of centre c and radius r
has an inner product above <q, c> + |q| r. It stops when the best bound left is
below the current kth score. That score is shared: queries go through the
shards in waves (one shard each, then seven, then ``WAVE`` at a time, each query
beginning elsewhere), and every wave starts from the kth score over all waves
before it. Bounds are doubles rounded up with a margin, scores are exact
integers, ties go to the smaller vec_id, so the result is that of comparing
everything.

A task holds one tree and at most about ``QUERIES_A_TASK`` queries; trees and the
answers of every wave are written out, so a lost executor costs its tasks of one
wave.

Cases: null vectors, and those with a null or non-finite component, take no
part; vectors of different widths aren't compared (empty ones score 0 among
themselves); components are held within +-sqrt(2^62 / width) after scaling, so
that no score leaves 64 bits; rows of one vec_id are candidates of their own and
each is a query, a row is excluded from its own answers only; a null vec_id is
no query and the last among ties; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SCALE, checked_broadcast, lean, numbered_rows, prepare, release_memory, scaled, table, written

K, EVERY = 5, 50
SHARD_NUMBERS = 1 << 20
#: Small tables get more shards than they need, so that all cores have one.
SPREAD_SHARDS, SPREAD_ROWS = 32, 4096
LEAF = 256
WAVE = 56
QUERIES_A_TASK = 8192
SALTS = 16
FOUND = "qid long, score long, vec_id long, row long"


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (vec_id,
    embedding) whose vec_id is divisible by ``every``, the ``k`` highest inner products
    with other rows."""
    spark = vectors.sparkSession
    prepare(spark)
    e = F.col("embedding")
    limit = F.least(F.lit((1 << 31) - 1), F.floor(F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size(e), F.lit(1)))))
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(e, limit).alias("v"))
    held = numbered_rows(spark, whole.filter("v is not null"), "row", "ball-vectors")

    first = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    distinct = held.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k + 1).drop("place")
    distinct = written(spark, distinct.withColumn("width", F.size("v")), "ball-distinct")
    asked = held.filter(F.col("vec_id") % every == 0)
    queries = asked.groupBy("v").agg(F.min("row").alias("qid")).withColumn("width", F.size("v"))
    queries = written(spark, queries, "ball-queries")

    # one row a width
    n = distinct.groupBy("width").agg(F.count("*").alias("n")).join(
        queries.groupBy("width").agg(F.count("*").alias("asked")), "width")
    shards = F.greatest(F.ceil(F.col("n") * F.greatest("width", F.lit(1)) / SHARD_NUMBERS),
                        F.least(F.lit(SPREAD_SHARDS), F.ceil(F.col("n") / SPREAD_ROWS)))
    sizes = written(spark, n.select("width", "asked", shards.cast("int").alias("shards")), "ball-sizes")
    small = checked_broadcast(sizes, 16)
    dealt = distinct.join(small, "width").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("shards")).cast("int"))
    trees = dealt.select("width", "shard", "shards", "asked", "vec_id", "row", "v").groupBy("width", "shard").applyInArrow(
        _planted, "width int, shard int, shards int, asked long, tree binary")
    trees = written(spark, trees, "ball-trees")
    queries = queries.join(small, "width")

    found, lo = None, 0
    for hi in _waves(sizes.agg(F.max("shards")).first()[0] or 0):
        found = _wave(spark, trees, queries, found, lo, hi, k + 1)
        lo = hi
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _answers(asked, queries, found, k)


def _waves(shards: int):
    """Where each wave over ``shards`` shards ends."""
    hi = min(1, shards)
    while hi:
        yield hi
        if hi == shards:
            return
        hi = min(shards, 8 if hi == 1 else hi + WAVE)


def _wave(spark: SparkSession, trees: DataFrame, queries: DataFrame, found: DataFrame | None, lo: int, hi: int,
          most: int) -> DataFrame:
    """The ``most`` best of ``found`` and of the shards at places ``lo`` to ``hi`` of each query."""
    parts = F.ceil(F.col("asked") * F.least(F.lit(hi - lo), F.col("shards")) / F.col("shards") / QUERIES_A_TASK).cast("int")
    if found is None:
        known = queries.withColumn("kth", F.lit(None).cast("long"))
    else:
        kth = found.groupBy("qid").agg(F.when(F.count("*") >= most, F.min("score")).alias("kth"))
        known = queries.join(kth, "qid", "left")
    places = F.sequence(F.lit(lo), F.least(F.lit(hi), F.col("shards")) - 1)
    sent = known.filter(F.col("shards") > lo).select("*", F.explode(places).alias("place")).select(
        "width", F.pmod(F.xxhash64("qid") + F.col("place"), F.col("shards")).cast("int").alias("shard"),
        F.pmod(F.xxhash64("qid", F.lit(1)), parts).cast("int").alias("part"), "qid", "v", "kth")
    copies = trees.select("width", "shard", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "tree")
    key = ["width", "shard", "part"]
    new = copies.groupBy(*key).cogroup(sent.groupBy(*key)).applyInArrow(_searcher(most), FOUND)
    best = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    both = new if found is None else new.unionAll(found)
    top = both.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= most).drop("at")
    return written(spark, top, "ball-found")


def _answers(asked: DataFrame, queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query row's list that aren't the row itself. A list
    is at most k + 1 rows; equal queries share one, which goes to ``SALTS`` places."""
    lists = found.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("less"), F.col("vec_id").isNull().alias("unnamed"), "vec_id", "row"))).alias("top"))
    lists = queries.select("qid", "v").join(lists, "qid").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = asked.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(lists, ["v", "salt"])
    own = rows.select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice(
        F.filter("top", lambda t: t["row"] != F.col("row")), 1, k)).alias("at", "t"))
    return own.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"),
                      (-F.col("t.less")).alias("score"))


def plant(v, leaf: int = LEAF):
    """Ball tree of the rows of an integer matrix: their order, and for each node
    begin, end, first child (0: a leaf; the second child follows), centre and radius."""
    import numpy as np

    v = np.asarray(v, np.float64)
    order = np.arange(len(v))
    nodes, centres, radii = [[0, len(v), 0]], [], []
    at = 0
    while at < len(nodes):
        lo, hi, _ = nodes[at]
        own = v[order[lo:hi]]
        centre = own.mean(0)
        away = ((own - centre) ** 2).sum(1)
        centres.append(centre)
        radii.append(np.sqrt(away.max()))
        if hi - lo > leaf:
            # along the line between two far points, halves of equal size
            one = own[away.argmax()]
            two = own[((own - one) ** 2).sum(1).argmax()]
            half = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(own @ (two - one), half)]
            nodes[at][2] = len(nodes)
            nodes += [[lo, lo + half, 0], [lo + half, hi, 0]]
        at += 1
    return order, np.array(nodes, np.int64), np.array(centres), np.array(radii)


def _planted(group):
    """One shard's rows as one row with its tree."""
    import numpy as np
    import pyarrow as pa

    try:
        width = group.column("width")[0].as_py()
        v = group.column("v").combine_chunks()
        v = np.asarray(v.flatten()).reshape(len(group), width)
        order, nodes, centres, radii = plant(v)
        ids = group.column("vec_id").combine_chunks()
        out = io.BytesIO()
        np.savez(out, v=v[order].astype(np.int32), ids=np.asarray(ids.fill_null(0))[order],
                 unnamed=np.asarray(ids.is_null())[order], rows=np.asarray(group.column("row"))[order],
                 nodes=nodes, centres=centres, radii=radii)
        return pa.table({c: group.column(c).slice(0, 1) for c in ("width", "shard", "shards", "asked")}
                        | {"tree": pa.array([out.getvalue()], pa.binary())})
    finally:
        release_memory()


class Tree:
    """A planted tree and its search."""

    def __init__(self, data: bytes):
        import numpy as np

        with np.load(io.BytesIO(data)) as f:
            self.v, self.ids, self.unnamed, self.rows = f["v"], f["ids"], f["unnamed"], f["rows"]
            self.nodes, self.centres, self.radii = f["nodes"].tolist(), f["centres"], f["radii"]
        self.largest = int(np.abs(self.v).max(initial=0))
        self.real = self.v.astype(np.float64)

    def bounds(self, queries):
        """The most that any vector of each node can score with each query."""
        import numpy as np

        q = queries.astype(np.float64)
        length = np.sqrt((q * q).sum(1))[:, None]
        reach = np.sqrt((self.centres ** 2).sum(1)) + self.radii
        return q @ self.centres.T + length * self.radii + 1e-9 * length * reach + 1e-6

    def search(self, query, bound, most: int, kth: int | None):
        """Places of the ``most`` best vectors of at least the score ``kth``, best
        first, and their scores; also how many leaves were looked at."""
        import heapq

        import numpy as np

        # doubles hold these sums exactly, or else integers are multiplied
        exact = int(np.abs(query).max(initial=0)) * self.largest * max(1, len(query)) < 1 << 53
        matrix, q = (self.real, query.astype(np.float64)) if exact else (self.v.astype(np.int64), query)
        places, scores, leaves = np.empty(0, np.int64), np.empty(0, np.int64), 0
        heap = [(-bound[0], 0)]
        while heap:
            most_left, node = heapq.heappop(heap)
            if kth is not None and -most_left < kth:
                break
            lo, hi, child = self.nodes[node]
            if child:
                for c in (child, child + 1):
                    if kth is None or bound[c] >= kth:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            leaves += 1
            got = (matrix[lo:hi] @ q).astype(np.int64)
            some = np.arange(len(got)) if kth is None else np.flatnonzero(got >= kth)
            if not len(some):
                continue
            places, scores = np.concatenate([places, lo + some]), np.concatenate([scores, got[some]])
            best = np.lexsort((self.rows[places], self.ids[places], self.unnamed[places], -scores))[:most]
            places, scores = places[best], scores[best]
            if len(scores) == most and (kth is None or scores[-1] > kth):
                kth = int(scores[-1])
        return places, scores, leaves


def _searcher(most: int):
    def run(trees, queries):
        import numpy as np
        import pyarrow as pa

        out = {c: [] for c in ("qid", "score", "vec_id", "row")}
        kinds = {c: pa.int64() for c in out}
        try:
            if len(trees) and len(queries):
                tree = Tree(trees.column("tree")[0].as_py())
                width = trees.column("width")[0].as_py()
                v = np.asarray(queries.column("v").combine_chunks().flatten()).reshape(len(queries), width)
                qids, kths = queries.column("qid").to_pylist(), queries.column("kth").to_pylist()
                for lo in range(0, len(v), 256):
                    bounds = tree.bounds(v[lo:lo + 256])
                    for i, bound in enumerate(bounds.tolist(), lo):
                        places, scores, _ = tree.search(v[i], bound, most, kths[i])
                        out["qid"] += [qids[i]] * len(places)
                        out["score"] += scores.tolist()
                        out["vec_id"] += [None if u else x for u, x in zip(tree.unnamed[places].tolist(), tree.ids[places].tolist())]
                        out["row"] += tree.rows[places].tolist()
            return pa.table({c: pa.array(x, kinds[c]) for c, x in out.items()})
        finally:
            release_memory()

    return run


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: 5 best of all other rows for every row whose vec_id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP11_SQL = f"""
WITH whole AS (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE))::DOUBLE[] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
pairs AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other,
    CASE WHEN len(q.v) = 0 THEN 0 WHEN len(q.v) = len(c.v) THEN list_inner_product(q.v, c.v) END::BIGINT AS score
    FROM whole q JOIN whole c ON len(q.v) = len(c.v) AND q.r <> c.r WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other))::INT AS rank, vec_id, score
FROM pairs QUALIFY rank <= {K}
"""
