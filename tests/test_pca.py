"""Randomised principal components against numpy and MLlib."""

import numpy as np
import pytest

from tabula.operators import pca


def frame(spark, x, more=()):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)] + list(more), "id long, v array<double>").repartition(4)


def test_exact_where_the_sketch_has_the_whole_width(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 1e6  # a large mean
    found = pca.fit(frame(spark, x), "v", 5)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(found.variance, values[::-1][:5], rtol=1e-6)
    assert np.allclose(np.abs(np.sum(found.vectors * vectors[:, ::-1][:, :5], 0)), 1, atol=1e-6)
    assert np.isclose(found.total_variance, values.sum(), rtol=1e-6) and found.n == 300
    assert (found.vectors[np.abs(found.vectors).argmax(0), np.arange(5)] > 0).all()


def test_wide_and_low_rank(spark):
    """400 features of which 6 directions carry nearly all variance."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) * [30, 20, 15, 10, 8, 5] @ rng.normal(size=(6, 400)) + 0.01 * rng.normal(size=(500, 400))
    found = pca.fit(frame(spark, x), "v", 6)
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1][:6]
    assert np.allclose(found.variance, values, rtol=1e-6) and found.ratio.sum() > 0.999
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(6), atol=1e-9)
    again = pca.fit(frame(spark, x), "v", 6, seed=7)
    assert np.allclose(np.abs(np.sum(found.vectors * again.vectors, 0)), 1, atol=1e-6)


def test_projection_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 4)) * [5, 3, 1, 0.1]
    bad = [(100, None), (101, [1.0]), (102, [1.0, 2.0, None, 4.0]), (103, [float("nan")] * 4)]
    df = frame(spark, x, bad)
    found = pca.fit(df, "v", 2)
    assert found.n == 50
    rows = {r["id"]: r for r in pca.project(df, "v", found).collect()}
    assert all(rows[k]["projected"] is None and rows[k]["projected_error"] is None for k, _ in bad)
    want = (x - x.mean(0)) @ found.vectors
    assert np.allclose([rows[i]["projected"] for i in range(50)], want)
    left = ((x - x.mean(0)) ** 2).sum() - (want ** 2).sum()
    assert np.isclose(sum(rows[i]["projected_error"] for i in range(50)), left)
    with pytest.raises(ValueError):
        pca.fit(df, "v", 9)
    with pytest.raises(ValueError):
        pca.fit(df.limit(0), "v", 1)
