import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabula.plans import models as mdl
from tabula.plans.prepare import DEFAULT_CONFIGS, PrepConfig, build_pipeline, run_configuration

from paths import SF_SMALL


@pytest.fixture(scope="module")
def emb(spark):
    return spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")


def test_scaler_range_and_pca_orthonormal(spark, emb):
    model = build_pipeline(list(range(64)), True, 5, vector_col="embedding").fit(emb)
    out = model.transform(emb)
    scaled = out.select(F.explode(vector_to_array("scaled_features")).alias("v"))
    lo, hi = scaled.agg(F.min("v"), F.max("v")).first()
    assert lo >= 0.0 and hi <= 1.0
    pc = model.stages[-1].pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(5), atol=1e-8)
    assert model.stages[-1].explainedVariance.toArray().sum() <= 1.0 + 1e-9


def test_constant_column_scales_to_half(spark):
    df = spark.createDataFrame([(1, 7.0, 1.0), (2, 7.0, 3.0)], "id long, a double, b double")
    m = build_pipeline([0, 1], True, None, wide_cols=["a", "b"]).fit(df)
    vals = [r["v"] for r in m.transform(df).select(vector_to_array("features")[0].alias("v")).collect()]
    assert vals == [0.5, 0.5]


def test_null_is_filled_for_every_input(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "id long, a double, b double")
    m = build_pipeline([0, 1], False, None, wide_cols=["a", "b"]).fit(df)
    v = m.transform(df).select(vector_to_array("features").alias("v")).first()["v"]
    assert list(v) == [1.0, 0.0]
    rows = [(i, i % 3, None if i % 5 == 0 else float(i), float(i % 7)) for i in range(100)]
    wide = spark.createDataFrame(rows, "id long, label int, a double, b double")
    res = run_configuration(spark, wide, PrepConfig("n"), key_col="id", wide_cols=["a", "b"], save=False)
    values = res["prepared"].select(F.explode(vector_to_array("features")).alias("v"))
    assert values.count() == 200 and values.filter("isnan(v) or v is null").count() == 0


def test_identical_rows_share_a_side_and_validation_stays_whole(spark):
    rows = [(i, 1, 2.0, 3.0) for i in range(50)] + [(100 + i, i % 4, float(i), float(i % 9)) for i in range(400)]
    wide = spark.createDataFrame(rows, "id long, label int, a double, b double")
    full = run_configuration(spark, wide, PrepConfig("n"), key_col="id", wide_cols=["a", "b"], save=False)["prepared"]
    assert full.filter("id < 50").select("split").distinct().count() == 1
    part = run_configuration(spark, wide, PrepConfig("n"), key_col="id", wide_cols=["a", "b"], save=False,
                             train_fraction=0.3)["prepared"]
    sides = {r["split"]: r["count"] for r in part.groupBy("split").count().collect()}
    assert sides["validation"] == full.filter("split = 'validation'").count() and sides["train"] < 250


def test_a_stored_preparation_is_used_again(spark, emb, tmp_path):
    args = dict(key_col="vec_id", vector_col="embedding", n_features=64, out_root=str(tmp_path))
    first = run_configuration(spark, emb, DEFAULT_CONFIGS[1], **args)
    again = run_configuration(spark, emb, DEFAULT_CONFIGS[1], **args)
    assert again["summary"] == first["summary"] and again["prepared"].count() == 500
    other = run_configuration(spark, emb.filter("label < 5"), DEFAULT_CONFIGS[1], **args)
    assert other["summary"]["data_path"] != first["summary"]["data_path"]


def test_neural_run_stops_early_and_publishes_the_best_epoch(spark, emb, tmp_path):
    import json

    from pyspark.ml.functions import vector_to_array

    from tabula.operators import evaluate as ev
    from tabula.plans import neural

    res = run_configuration(spark, emb, DEFAULT_CONFIGS[1], key_col="vec_id", vector_col="embedding", n_features=64, save=False)
    train, val = (res["prepared"].filter(f"split = '{s}'") for s in ("train", "validation"))
    with pytest.raises(mdl.QualityGateError):
        neural.neural_run(spark, train, val, 64, 10, str(tmp_path), epochs=2, passes=2)
    with pytest.raises(FileNotFoundError):
        mdl.load_best(spark, str(tmp_path / "models"))
    run = neural.neural_run(spark, train, val, 64, 10, str(tmp_path), prep_model=res["model"], min_accuracy=0.0, epochs=30, passes=5)
    doc = json.loads(spark.read.text(str(tmp_path / "multilayer_perceptron_metrics")).first()[0])
    history = doc["history"]
    accuracies = [h["validation_accuracy"] for h in history]
    # stopped by the rule, long before the last epoch allowed
    assert doc["epochs_completed"] == len(history) == run.best_epoch + neural.PATIENCE < 30
    assert run.best_epoch == doc["best_epoch"] == 1 + accuracies.index(max(accuracies))
    assert history[-1]["train_loss"] < history[0]["train_loss"]
    assert doc["train_samples"] + doc["validation_samples"] == emb.count() and len(doc["class_metrics"]) == 10
    # the published model is that epoch's: its loss and accuracy are found again
    name, model = mdl.load_best(spark, str(tmp_path / "models"))
    assert name == neural.NAME and model.transform(emb).count() == 500
    pred = model.stages[-1].transform(val).withColumn("probability", vector_to_array("probability"))
    again = ev.log_loss(pred).first()
    assert abs(again["accuracy"] - max(accuracies)) < 1e-12
    assert abs(again["loss"] - history[run.best_epoch - 1]["validation_loss"]) < 1e-9


def test_epochs_go_on_from_the_last_weights(spark, emb):
    from tabula.plans import neural

    res = run_configuration(spark, emb, DEFAULT_CONFIGS[1], key_col="vec_id", vector_col="embedding", n_features=64, save=False)
    train, val = (res["prepared"].filter(f"split = '{s}'") for s in ("train", "validation"))
    run = neural.train_epochs(spark, train, val, [64, 16, 10], epochs=4, passes=3, patience=9)
    losses = [r["train_loss"] for r in run.history.orderBy("epoch").collect()]
    assert len(losses) == 4 and losses == sorted(losses, reverse=True)
    with pytest.raises(ValueError):
        neural.train_epochs(spark, train, val, [64, 10], epochs=0)


def test_one_pass_counts_every_model(spark, emb):
    from tabula.operators import evaluate as ev

    res = run_configuration(spark, emb, DEFAULT_CONFIGS[1], key_col="vec_id", vector_col="embedding", n_features=64, save=False)
    train, val = (res["prepared"].filter(f"split = '{s}'") for s in ("train", "validation"))
    models = {n: e.fit(train) for n, e in mdl.build_classifiers(64)}
    together = {tuple(r) for r in mdl.count_predictions(val, models)}
    alone = {(n, *r) for n, m in models.items() for r in ev.label_prediction_counts(m.transform(val)).collect()}
    assert together == alone


def test_prune_all_columns_is_clear_error():
    with pytest.raises(ValueError):
        build_pipeline([], True, 50)


def test_configuration_fits_on_train_only(spark, emb):
    unlabelled = emb.drop("label")
    res = run_configuration(spark, emb, DEFAULT_CONFIGS[3], key_col="vec_id", vector_col="embedding", n_features=64,
                            test_df=unlabelled)
    assert res["summary"]["test_rows"] == emb.count() and res["test"].columns == ["vec_id", "features"]
    s = res["summary"]
    assert s["feature_dimension"] == 50 and s["train_rows"] + s["validation_rows"] == emb.count()
    sides = {r["split"]: r["count"] for r in res["prepared"].groupBy("split").count().collect()}
    assert set(sides) == {"train", "validation"}
    # pruning is decided on the train side: an all-zero column is dropped
    wide = spark.range(400).select("id", F.lit(0.0).alias("p0"), (F.col("id") % 7).cast("double").alias("p1"),
                                   (F.col("id") % 3).alias("label"))
    r = run_configuration(spark, wide, PrepConfig("wide", drop_empty=True), key_col="id",
                          wide_cols=["p0", "p1"], save=False)
    assert r["dims"] == [1] and r["summary"]["removed_columns"] == 1


def test_compare_publish_load_and_gate(spark, emb, tmp_path, monkeypatch):
    res = run_configuration(spark, emb, DEFAULT_CONFIGS[1], key_col="vec_id", vector_col="embedding", n_features=64)
    data = res["prepared"]
    train, val = data.filter("split = 'train'"), data.filter("split = 'validation'")
    clfs = mdl.build_classifiers(64, include_mlp=False)
    clfs.append(("broken", mdl.LogisticRegression(featuresCol="nope")))
    comp = mdl.compare_models(spark, train, val, clfs)
    rows = {r["model"]: r for r in comp.results.collect()}
    assert rows["broken"]["status"].startswith("failed:")
    assert all(rows[m]["status"] == "ok" for m in ("logistic_regression", "decision_tree", "random_forest"))
    root = str(tmp_path / "models")
    with pytest.raises(mdl.QualityGateError):
        mdl.publish_best(spark, comp, res["model"], root, min_accuracy=0.99)
    with pytest.raises(FileNotFoundError):
        mdl.load_best(spark, root)  # nothing published after a failed gate
    best = mdl.publish_best(spark, comp, res["model"], root, min_accuracy=0.0)
    name, model = mdl.load_best(spark, root)
    assert name == best["model"]
    mdl.publish_best(spark, comp, res["model"], root, min_accuracy=0.0)
    name, path = mdl.resolve_model(spark, root)
    assert name == best["model"] and mdl.load_best(spark, path=path)[0] in path
    monkeypatch.setenv(mdl.MODEL_PATH_VARIABLE, path + "-gone")
    with pytest.raises(FileNotFoundError):
        mdl.load_best(spark, root)
    monkeypatch.delenv(mdl.MODEL_PATH_VARIABLE)
    scored = model.transform(emb)
    assert scored.count() == emb.count()
    mdl.write_reports(spark, comp, str(tmp_path / "reports"), range(10))
    cm = spark.read.option("header", "true").option("inferSchema", "true").csv(str(tmp_path / "reports/confusion_matrix_random_forest"))
    assert cm.count() == 10 and len(cm.columns) == 12


def test_input_identity_tracks_rewrites(spark, tmp_path):
    import time

    from tabula.plans.prepare import input_identity

    p = str(tmp_path / "t")
    spark.range(10).write.parquet(p)
    a = input_identity(spark, spark.read.parquet(p))
    assert a == input_identity(spark, spark.read.parquet(p))
    time.sleep(1.1)
    spark.range(10).write.mode("overwrite").parquet(p)
    assert input_identity(spark, spark.read.parquet(p)) != a
    whole = spark.read.parquet(p)
    assert input_identity(spark, whole) != input_identity(spark, whole.filter("id > 3"))
    one, two = (spark.createDataFrame([(k,)], "id long") for k in (1, 2))
    assert input_identity(spark, one) != input_identity(spark, two)
