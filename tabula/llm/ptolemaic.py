"""Centroid clustering with Ptolemaic pivots.

Lloyd's rounds on integer vectors under the squared Euclidean distance. Some of
the first centroids are fixed pivots. A vector's distances to them are computed
once and kept beside it; Ptolemy's inequality then bounds its distance to any
centroid c from below, for every pair of pivots p, q:

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

Only centroids whose bound, rounded down with a margin for the doubles it is
made of, doesn't exceed the distance to the centroid of the round before are
looked at, and these exactly, in integers. So every assignment is the one that
a full comparison would make.

A round is one pass: each task adds up its vectors by cluster, so at most one
row per task and cluster is shuffled. The driver holds the centroids
(``clusters`` times the width, at most ``MAX_NUMBERS`` numbers) and takes the
exact floor of sum / count. The vectors are written once with their pivot
distances, the last assignment once more; a lost executor repeats its tasks of
one round.

Cases: vectors of another width, null ones, and those with a null or non-finite
component take no part; components beyond ``LIMIT`` in size after scaling count
as ``LIMIT`` (no distance can then leave 64 bits; an inertia beyond them is the largest long); repeated rows are vectors of their own, and equal
centroids leave the later one empty; a null vec_id hashes as the empty string,
ties between equal hashes go to the smaller vector; fewer vectors than clusters
give fewer clusters; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SCALE, lean, prepare, scaled, table, written

CLUSTERS, ROUNDS, WIDTH, SEED = 40, 5, 64, 2
PIVOTS = 6
#: Most centroid components, which bounds what the driver and every task hold.
MAX_NUMBERS = 1 << 20
LIMIT = 1 << 26
#: Vectors compared at once in a task.
STEP = 4096


def kept_vectors(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """``vec_id, v`` of the vectors that take part."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("e"))
    return rows.filter(F.size("e") == width).select("vec_id", scaled(F.col("e"), F.lit(LIMIT)).alias("v")).filter("v is not null")


def first_centroids(kept: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The ``clusters`` vectors of the smallest hashes, in order (a top-k, kept small in every task)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r.v) for r in kept.select(digest.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()]


def choose_pivots(centroids: list[list[int]], most: int = PIVOTS) -> list[list[int]]:
    """Up to ``most`` different centroids, each the furthest from those before it."""
    import numpy as np

    some = np.array(centroids, np.float64)
    if not len(some):
        return []
    chosen, near = [0], ((some - some[0]) ** 2).sum(1)
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((some - some[chosen[-1]]) ** 2).sum(1))
    return [centroids[i] for i in chosen]


def cluster(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH,
            seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of each vector that takes part, and the final centroids."""
    if clusters * width > MAX_NUMBERS:
        raise ValueError(f"clusters * width: at most {MAX_NUMBERS}")
    spark = rows.sparkSession
    prepare(spark)
    kept = kept_vectors(rows, width)
    centroids = first_centroids(kept, clusters, seed)
    pivots = choose_pivots(centroids)
    held = written(spark, kept.mapInArrow(lean(_pivot_distances(pivots)), "vec_id long, v array<long>, p array<double>"),
                   "cluster-vectors")
    for number in range(rounds):
        if not centroids:
            break
        part = held.select("v", "p").mapInArrow(lean(_summed(centroids, pivots)), "cluster int, n long, sums array<long>")
        # every partial sum is a row of its own width; totals may leave 64 bits
        total = (part.select("cluster", "n", F.posexplode("sums").alias("place", "s"))
                 .groupBy("cluster", "place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")))
        centroids = [list(c) for c in centroids]
        for r in total.collect():
            centroids[r.cluster][r.place] = int(r.s) // r.n
    assigned = held.mapInArrow(lean(_assigned(centroids, pivots)), "vec_id long, cluster int, distance long")
    return written(spark, assigned, "cluster-assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``assigned`` with its cluster's and the whole inertia and the centroid's digest."""
    spark = assigned.sparkSession
    # one row a cluster
    sums = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    most = (1 << 63) - 1
    named = [(i, min(sums[i], most), min(sum(sums.values()), most), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
             for i, c in enumerate(centroids) if i in sums]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def nearest(x, distances, centroids, pivots):
    """Numbers of the nearest centroids of the integer vectors ``x``, the squared
    distances, and how many exact distances that took. ``distances`` are those of ``x`` to the pivots."""
    import numpy as np

    n, k = len(x), len(centroids)
    to_pivots = _roots(centroids, pivots)
    apart = _roots(pivots, pivots)
    low = np.zeros((n, k))
    for i in range(len(pivots)):
        for j in range(i):
            one, two = np.outer(distances[:, i], to_pivots[:, j]), np.outer(distances[:, j], to_pivots[:, i])
            # each product of rounded roots is off by a few units in its last place
            bound = (np.abs(one - two) - (one + two) * 1e-12) / apart[i, j]
            np.maximum(low, bound, out=low)
    best = low.argmin(1) if len(pivots) > 1 else np.zeros(n, np.int64)
    least = _squares(x, centroids[best])
    taken = n
    # what may be as near as the first guess, with a margin for the square
    maybe = low * low * (1 - 1e-12) <= least[:, None]
    maybe[np.arange(n), best] = False
    row, column = np.nonzero(maybe)
    for lo in range(0, len(row), STEP * 4):
        r, c = row[lo:lo + STEP * 4], column[lo:lo + STEP * 4]
        still = low[r, c] ** 2 * (1 - 1e-12) <= least[r]
        r, c = r[still], c[still]
        taken += len(r)
        d = _squares(x[r], centroids[c])
        order = np.lexsort((c, d, r))
        r, c, d = r[order], c[order], d[order]
        new = np.concatenate([[True], r[1:] != r[:-1]]) if len(r) else np.empty(0, bool)
        r, c, d = r[new], c[new], d[new]
        better = (d < least[r]) | ((d == least[r]) & (c < best[r]))
        best[r[better]], least[r[better]] = c[better], d[better]
    return best, least, taken


def _squares(a, b):
    d = a - b
    return (d * d).sum(1)


def _roots(a, b):
    import numpy as np

    a, b = np.asarray(a, np.float64), np.asarray(b, np.float64)
    out = np.zeros((len(a), len(b)))
    for j in range(len(b)):
        out[:, j] = np.sqrt(((a - b[j]) ** 2).sum(1))
    return out


def _matrix(column):
    """The rows of an Arrow list column of one width."""
    import numpy as np

    n = len(column)
    first, last = (column.offsets[0].as_py(), column.offsets[n].as_py()) if n else (0, 0)
    return column.values.to_numpy()[first:last].reshape(n, -1) if last > first else np.zeros((n, 0))


def _pivot_distances(pivots):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = _matrix(batch.column("v"))
            far = _roots(x, pivots) if pivots else np.zeros((len(x), 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * far.shape[1]), pa.array(far.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), lists], ["vec_id", "v", "p"])

    return run


def _parts(batch, centroids, pivots):
    """Vectors, clusters and distances of a batch, ``STEP`` vectors at a time."""
    for lo in range(0, batch.num_rows, STEP):
        part = batch.slice(lo, STEP)
        x = _matrix(part.column("v"))
        best, least, _ = nearest(x, _matrix(part.column("p")), centroids, pivots)
        yield part, x, best, least


def _summed(centroids, pivots):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        places, fixed = np.array(centroids, np.int64), np.array(pivots, np.int64)
        sums, counts = np.zeros(places.shape, np.int64), np.zeros(len(places), np.int64)

        def rows():
            some = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))],
                ["cluster", "n", "sums"])

        for batch in batches:
            for _, x, best, _ in _parts(batch, places, fixed):
                np.add.at(sums, best, x)
                counts += np.bincount(best, minlength=len(counts))
                if counts.sum() * LIMIT >= 1 << 62:  # before a sum can leave 64 bits
                    yield rows()
                    sums[:], counts[:] = 0, 0
        yield rows()

    return run


def _assigned(centroids, pivots):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        places, fixed = np.array(centroids, np.int64), np.array(pivots, np.int64)
        for batch in batches:
            for part, _, best, least in _parts(batch, places, fixed):
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(least)],
                                                 ["vec_id", "cluster", "distance"])

    return run


def op12_ptolemaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every
    kept vector: 40 clusters, 5 rounds, one more assignment."""
    return with_inertia(*cluster(table(spark, sf_dir, "embeddings")))


def _oracle() -> str:
    steps = [f"""rows AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}),
cells AS MATERIALIZED (SELECT r, unnest(range({WIDTH})) AS place, unnest(v) AS x FROM rows),
c0 AS MATERIALIZED (SELECT k, unnest(range({WIDTH})) AS place, unnest(v) AS y FROM (
    SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k, v
    FROM rows QUALIFY k < {CLUSTERS}))"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, k := k)) AS m FROM (
    SELECT r, k, sum((x - y) * (x - y))::BIGINT AS d FROM cells JOIN c{i} USING (place) GROUP BY r, k) GROUP BY r)""")
        if i < ROUNDS:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT k, place, coalesce(new, y) AS y FROM c{i} LEFT JOIN (
    SELECT m.k AS k, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS new
    FROM cells JOIN a{i} USING (r) GROUP BY 1, 2) USING (k, place))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, m.k::INT AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.k))::BIGINT AS cluster_inertia,
       (sum(m.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM rows JOIN a{ROUNDS} USING (r) JOIN (
    SELECT k, sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k) f ON f.k = m.k
"""


OP12_SQL = _oracle()
