"""Statistics operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabula.operators import features as feat
from tabula.operators import stats


def test_counts_in_both_forms(spark):
    values = [(2, -4), (5, 17), (2, 0), (9, 3), (5, 1), (5, 0), (9, 8)]
    frame = spark.createDataFrame(values, "label bigint, level bigint")
    frame.createOrReplaceTempView("levels")
    want = sum(v > 0 for _, v in values)
    assert spark.sql("SELECT COUNT(*) AS n FROM levels WHERE level > 0").first()["n"] == want
    assert frame.filter(F.col("level") > 0).count() == want
    for counts in (stats.label_counts(frame), stats.label_counts_sql(spark, frame)):
        assert [tuple(r) for r in counts.collect()] == [(2, 2), (5, 3), (9, 2)]


def test_column_stats_nulls_single_row_and_zeros(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, None, 5.0), (3, 4.0, None)], "id long, a double, b double")
    long_df = feat.wide_to_long(df, ["a", "b"], "id")
    s = {r["dim"]: r for r in stats.column_stats(long_df).collect()}
    assert s[0]["zeros"] == 1 and s[0]["mean"] == 2.0 and s[0]["min"] == 0.0
    one = feat.wide_to_long(df.limit(1), ["a"], "id")
    assert stats.column_stats(one).first()["std"] is None  # sample std of one row


def test_feature_order_and_pruning(spark):
    assert feat.feature_columns(["label", "pixel10", "pixel2", "x", "pixel0"]) == ["x", "pixel0", "pixel2", "pixel10"]
    df = spark.createDataFrame([(i, 0.0, float(i % 2), None) for i in range(100)], "id long, a double, b double, c double")
    sel = feat.select_informative(feat.wide_to_long(df, ["a", "b", "c"], "id"), 0.98)
    assert feat.kept_dims(sel, 3) == [1, 2]  # all-zero dropped; nulls are not zeros
    assert feat.kept_dims(sel.limit(0), 3) == [0, 1, 2]  # empty input keeps all


def test_class_correlation_matches_numpy(spark):
    rng = np.random.default_rng(1)
    means = rng.normal(size=(4, 30))
    rows = [(int(l), int(d), float(means[l, d])) for l in range(3) for d in range(30)]
    df = spark.createDataFrame(rows, "label int, dim int, mean double")
    out = {(r["label_a"], r["label_b"]): r["r"] for r in stats.class_correlation(df, [0, 1, 2, 3]).collect()}
    assert len(out) == 16
    for a in range(3):
        for b in range(3):
            assert out[(a, b)] == pytest.approx(np.corrcoef(means[a], means[b])[0, 1], abs=1e-9)
    assert out[(3, 0)] == 0.0 and out[(3, 3)] == 0.0  # missing class -> 0


def test_pair_difference_and_status(spark):
    rows = [(l, d, float(l * d)) for l in (1, 7, 3) for d in range(4)]
    m = spark.createDataFrame(rows, "label int, dim int, mean double")
    d = stats.class_pair_difference(spark, m, [(1, 7), (3, 8)]).collect()
    assert len(d) == 4 and all(r["abs_diff"] == 6 * r["dim"] for r in d)
    st = {(r["label_a"], r["label_b"]): r["available"] for r in stats.class_pair_status(spark, m, [(1, 7), (3, 8)]).collect()}
    assert st == {(1, 7): True, (3, 8): False}


def test_minmax_constant_is_half(spark):
    df = spark.createDataFrame([(1, 0, 3.0), (2, 0, 3.0), (1, 1, 0.0), (2, 1, 10.0)], "vec_id long, dim int, x double")
    out = {(r["vec_id"], r["dim"]): r["scaled"] for r in feat.minmax_scale_long(df).collect()}
    assert out[(1, 0)] == 0.5 and out[(2, 1)] == 1.0 and out[(1, 1)] == 0.0


def test_global_mean_vector_incomplete(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0)], "vec_id long, dim int, x double")
    r = stats.global_mean_vector(df, 784).first()
    assert r["n_dims"] == 2 and r["complete"] is False and r["mean_vector"] == [1.0, 3.0]


def test_minmax_array_equals_long(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0, 2.0]), (2, [3.0, 5.0, 0.0]), (3, [2.0, 5.0, 4.0])],
                               "vec_id long, v array<double>")
    lo, hi = feat.minmax_fit(df, "v")
    assert lo == [1.0, 5.0, 0.0] and hi == [3.0, 5.0, 4.0]
    arr = {r["vec_id"]: r["scaled"] for r in feat.minmax_scale_array(df, "v", lo, hi).collect()}
    long_df = feat.vector_to_long(df, "v", "vec_id", None)
    for r in feat.minmax_scale_long(long_df).collect():
        assert arr[r["vec_id"]][r["dim"]] == r["scaled"]
    assert arr[1][1] == 0.5


def test_statistics_compute_or_reuse(spark, tmp_path):
    from tabula.plans.statistics import compute_statistics
    from tabula.sources.tables import feature_dimension, to_arrow_small

    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    long_df = feat.vector_to_long(e)
    root = str(tmp_path / "stats")
    first = compute_statistics(spark, long_df, e.select("label"), root)
    assert first["class_means"].count() == 640 and first["frequencies"].count() == 10
    # second run reuses the written tables even when the input is different
    again = compute_statistics(spark, long_df.limit(0), e.select("label").limit(0), root)
    assert again["column_stats"].count() == 64
    forced = compute_statistics(spark, long_df.limit(0), e.select("label").limit(0), root, force=True)
    assert forced["column_stats"].count() == 0
    assert feature_dimension(e, "embedding") == 64
    with pytest.raises(ValueError):
        feature_dimension(e.limit(0), "embedding")
    assert to_arrow_small(e.select("vec_id"), 1000).num_rows == 500
    with pytest.raises(ValueError):
        to_arrow_small(e.select("vec_id"), 10)


def test_metrics_json(spark, tmp_path):
    import json

    from tabula.sources.tables import write_metrics_json

    h = spark.createDataFrame([(1, 0.5), (2, 0.6)], "epoch int, validation_accuracy double")
    write_metrics_json(spark, str(tmp_path / "m"), {"model": "mlp", "epochs_completed": 2}, history=h)
    doc = json.loads(spark.read.text(str(tmp_path / "m")).first()[0])
    assert doc["model"] == "mlp" and [e["epoch"] for e in doc["history"]] == [1, 2]


def test_constant_class_vector_and_empty_arrays(spark):
    rows = [(0, d, 1.0) for d in range(5)] + [(1, d, float(d)) for d in range(5)]
    df = spark.createDataFrame(rows, "label int, dim int, mean double")
    out = {(r["label_a"], r["label_b"]): r["r"] for r in stats.class_correlation(df, [0, 1]).collect()}
    assert out[(0, 1)] == 0.0 and out[(1, 1)] == pytest.approx(1.0)
    e = spark.createDataFrame([(0, []), (0, [1.0, -1.0])], "label int, embedding array<double>")
    r = stats.ink_density(e).first()
    assert r["n"] == 2 and r["avg_ink_ratio"] == 0.5  # the empty row has no ratio and is skipped


def test_many_classes_in_blocks(spark, monkeypatch):
    """Several blocks, missing dims, a constant class: numpy's coefficients over the dims that two classes share."""
    import numpy as np

    monkeypatch.setattr(stats, "BLOCK_CLASSES", 7)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 12)) + 100
    x[3] = 0.1
    has = rng.random((40, 12)) < 0.9
    rows = [(c, d, float(x[c, d])) for c in range(40) for d in range(12) if has[c, d]]
    got = {(r["label_a"], r["label_b"]): r["r"] for r in stats.class_correlation(
        spark.createDataFrame(rows, "label int, dim int, mean double")).collect()}
    assert len(got) == 1600
    for a in range(40):
        for b in range(40):
            both = has[a] & has[b]
            want = 0.0 if 3 in (a, b) or both.sum() < 2 else np.corrcoef(x[a, both], x[b, both])[0, 1]
            assert abs(got[a, b] - want) < 1e-9, (a, b)
