"""Operators 11, 12 and 13 against brute force."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from helpers import SF, awkward_docs, by_row, empty_docs, rows, words5
from hypothesis import given, settings
from hypothesis import strategies as st

from tabula.llm import ball_tree, importance, ptolemaic
from tabula.llm.registry import ORACLE, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, row string, qid string, v string, shard string, cluster string, p string"
MORE = (1, "r", "q", "v", "s", "c", "p")


def awkward_vectors(spark, tmp_path, width=64):
    rng = random.Random(3)
    data = [(i, [rng.gauss(0, 1) for _ in range(width)], *MORE) for i in range(400)]
    common = [rng.choice([-0.5, 0.25, 1.0]) for _ in range(width)]
    data += [(1000 + i, common, *MORE) for i in range(200)]  # a third are equal, ids 1000, 1050, ... ask
    data += [data[0], data[50], data[50], (100, data[7][1], *MORE), (None, data[50][1], *MORE), (None, data[3][1], *MORE)]
    data += [(2000, None, *MORE), (2050, [None] * width, *MORE), (2100, [math.nan] * width, *MORE),
             (2150, [math.inf] + [0.0] * (width - 1), *MORE), (2200, [], *MORE), (2201, [], *MORE), (2250, [1.0, -2.0], *MORE),
             (2251, [0.5, 0.5], *MORE), (2300, [0.0] * width, *MORE), (2350, [1e5] * width, *MORE), (2351, [-1e5] + [1.0] * (width - 1), *MORE)]
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(data, VECTORS).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def whole(df, limit=None):
    out = []
    for r in df.collect():
        e = r.embedding
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            out.append((r.vec_id, [math.floor(256 * x) for x in e]))
    return out


def brute_top(vectors, k=5, every=50):
    out = []
    for i, (q, v) in enumerate(vectors):
        if q is not None and q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c is None, c or 0) for j, (c, w) in enumerate(vectors)
                            if i != j and len(v) == len(w))
            out += [(q, r + 1, None if u else c, -s) for r, (s, u, c) in enumerate(scored[:k])]
    return collections.Counter(out)


@pytest.mark.parametrize("spread, leaf", [(4096, 256), (16, 8)])
def test_top_k(spark, tmp_path, monkeypatch, spread, leaf):
    """Few large shards, and many small ones in several waves."""
    monkeypatch.setattr(ball_tree, "SPREAD_ROWS", spread)
    monkeypatch.setattr(ball_tree, "WAVE", 9)
    df = awkward_vectors(spark, tmp_path)
    got = by_row(ball_tree.top_k(df), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(whole(df))


def test_top_k_of_little(spark):
    one = spark.createDataFrame([(50, [1.0, 2.0]), (7, [2.0, 0.0]), (8, [1.0])], "vec_id long, embedding array<double>")
    assert by_row(ball_tree.top_k(one), "query_id", "rank", "vec_id", "score") == {(50, 1, 7, 131072): 1}
    assert ball_tree.top_k(one.limit(0)).count() == 0
    assert ball_tree.top_k(one.filter("vec_id = 7")).count() == 0
    huge = spark.createDataFrame([(0, [3e38, 1.0]), (1, [3e38, 3e38]), (2, [-3e38, 1.0])], "vec_id long, embedding array<float>")
    got = ball_tree.top_k(huge).collect()
    limit = math.floor(math.sqrt(2.0 ** 62 / 2))
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [
        (1, 1, limit * limit + 256 * limit), (2, 2, -limit * limit + 256 * 256)]


@given(st.integers(0, 2 ** 32), st.integers(1, 60), st.integers(1, 6), st.sampled_from([1, 7, 10 ** 4, 2 ** 29]))
@settings(max_examples=60, deadline=None)
def test_tree_search(seed, n, width, size):
    """Any tree gives the best of all, ties by id, whatever score it starts from."""
    import io

    rng = np.random.default_rng(seed)
    v = rng.integers(-size, size + 1, (n, width))
    order, nodes, centres, radii = ball_tree.plant(v, leaf=4)
    assert sorted(order) == list(range(n))
    out, ids = io.BytesIO(), rng.integers(0, 9, n)
    np.savez(out, v=v[order].astype(np.int32), ids=ids[order], unnamed=np.zeros(n, bool), rows=order, nodes=nodes,
             centres=centres, radii=radii)
    tree = ball_tree.Tree(out.getvalue())
    q = rng.integers(-size, size + 1, width)
    expected = sorted((-sum(int(a) * int(b) for a, b in zip(q, w)), i, r) for r, (w, i) in enumerate(zip(v, ids)))
    bound = tree.bounds(q[None, :])[0].tolist()
    for kth in (None, -expected[min(3, n) - 1][0]):
        places, scores, _ = tree.search(q, bound, 3, kth)
        got = list(zip((-scores).tolist(), tree.ids[places].tolist(), tree.rows[places].tolist()))
        assert got == [tuple(map(int, e)) for e in expected[:3]]


def test_the_tree_prunes():
    """Well apart clusters: a query looks at few leaves only."""
    import io

    rng = np.random.default_rng(1)
    v = np.concatenate([rng.integers(-20, 20, (200, 8)) + 1000 * c for c in rng.integers(-5, 6, (40, 8))])
    order, nodes, centres, radii = ball_tree.plant(v, leaf=64)
    out = io.BytesIO()
    np.savez(out, v=v[order].astype(np.int32), ids=order, unnamed=np.zeros(len(v), bool), rows=order, nodes=nodes, centres=centres, radii=radii)
    tree = ball_tree.Tree(out.getvalue())
    bounds = tree.bounds(v[::100])
    looked = [tree.search(q, b, 5, None)[2] for q, b in zip(v[::100], bounds.tolist())]
    assert np.mean(looked) < 0.2 * (nodes[:, 2] == 0).sum()


def brute_clusters(vectors, k=40, rounds=5):
    kept = [(i, v) for i, v in vectors if len(v) == 64]
    first = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for (_, v), (_, j) in zip(kept, assign()):
            groups[j].append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(col) // len(vs) for col in zip(*vs)]
    final, inertia = assign(), collections.Counter()
    for d, j in final:
        inertia[j] += d
    return collections.Counter(
        (i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(kept, final))


CLUSTERED = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def test_clusters(spark, tmp_path):
    df = awkward_vectors(spark, tmp_path)
    assert by_row(ptolemaic.with_inertia(*ptolemaic.cluster(df)), *CLUSTERED) == brute_clusters(whole(df))


def test_clusters_of_little(spark):
    few = spark.createDataFrame([(i % 3, [float(i % 2)] * 64) for i in range(7)], "vec_id long, embedding array<float>")
    assert by_row(ptolemaic.with_inertia(*ptolemaic.cluster(few)), *CLUSTERED) == brute_clusters(whole(few))
    assert ptolemaic.with_inertia(*ptolemaic.cluster(few.limit(0))).count() == 0
    far = spark.createDataFrame([(1, [3e38] * 64), (2, [-3e38] * 64), (3, [0.0] * 64)], "vec_id long, embedding array<float>")
    assert ptolemaic.with_inertia(*ptolemaic.cluster(far)).agg({"distance": "max"}).first()[0] == 0


@given(st.integers(0, 2 ** 32), st.integers(1, 12), st.sampled_from([1, 3, 100, 2 ** 26]))
@settings(max_examples=80, deadline=None)
def test_nearest(seed, k, size):
    rng = np.random.default_rng(seed)
    x, c = rng.integers(-size, size + 1, (50, 5)), rng.integers(-size, size + 1, (k, 5))
    pivots = np.array(ptolemaic.choose_pivots(c.tolist()))
    best, least, taken = ptolemaic.nearest(x, ptolemaic._roots(x, pivots), c, pivots)
    exact = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == exact.argmin(1)).all() and (least == exact.min(1)).all()
    assert taken <= 50 * k


def test_bounds_spare_distances():
    """Groups well apart: most exact distances are never computed."""
    rng = np.random.default_rng(4)
    c = rng.integers(-4000, 4000, (40, 64))
    x = np.repeat(c, 50, 0) + rng.integers(-50, 50, (2000, 64))
    pivots = np.array(ptolemaic.choose_pivots(c.tolist()))
    _, _, taken = ptolemaic.nearest(x, ptolemaic._roots(x, pivots), c, pivots)
    assert taken < 0.25 * 2000 * 40


def brute_importance(docs, target, longest=1, buckets=10_000):
    def features(text):
        w = words5(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    found = [(i, len(words5(t)), features(t)) for i, t in docs]
    s, t = collections.Counter(b for _, _, f in found for b in f), collections.Counter(b for x in target for b in features(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in s}
    out = []
    for i, n, f in found:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(able[:10 * len(able) // 100]):
        r[5] = k + 1
    return collections.Counter(map(tuple, out))


WEIGHED = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("longest, part", [(1, 20_000), (3, 50)])
def test_importance(spark, tmp_path, monkeypatch, longest, part):
    monkeypatch.setattr(importance, "PART_CHARS", part)
    docs = awkward_docs(spark, tmp_path)
    texts = [r["text"] for r in rows("benchmark")] + [None, ""]
    target = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "item_id long, text string, n_words int")
    got = by_row(importance.importance(docs, target, longest=longest), *WEIGHED)
    assert got == brute_importance([(r.doc_id, r.text) for r in docs.collect()], texts, longest)


def test_importance_of_little(spark):
    docs = spark.createDataFrame([(i % 4, "Wort wort " * 10) for i in range(20)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    got = importance.importance(docs, none)
    assert by_row(got, *WEIGHED) == brute_importance([(r.doc_id, r.text) for r in docs.collect()], [])
    assert sorted(r["rank"] for r in got.filter("rank is not null").collect()) == [1, 2]
    assert importance.importance(empty_docs(spark), docs).count() == 0
    assert importance.importance(docs.filter("doc_id < 0"), none).count() == 0


@given(st.text(alphabet="ab 1Éß.\n漢A", max_size=60), st.integers(1, 5), st.integers(1, 3))
@settings(max_examples=150, deadline=None)
def test_runs_of_words(text, limit, longest):
    split, words = importance._splitter(), words5(text)
    got = [r for _, runs in importance.features(split, text, longest, limit) for r in runs]
    expected = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    assert collections.Counter(got) == collections.Counter(expected)
    assert "".join(importance.parts(text, limit)) == text


@pytest.mark.parametrize("name", ["op11_ball_tree", "op12_ptolemaic", "op13_importance"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    found = con.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(columns)
    assert by_row(got, *columns) == collections.Counter(found.fetchall())
