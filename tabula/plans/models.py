"""Classifier comparison.

Each fit is an MLlib job that runs on the executors; the driver only loops
over the handful of estimators. All models are evaluated in one pass that
counts (model, label, prediction); the confusion matrices, per-class and
overall metrics are all derived from these counts.
"""

from __future__ import annotations

import os
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators import evaluate as ev
from tabula.sources import versions
from tabula.sources.tables import path_exists

RESULT_SCHEMA = ("model string, ordinal int, accuracy double, f1 double, weighted_precision double, "
                 "weighted_recall double, train_s double, eval_s double, status string")


def build_classifiers(n_features: int, n_classes: int = 10, seed: int = 42,
                      include_mlp: bool = True) -> list[tuple[str, object]]:
    """H4 (logistic regression), H5 (decision tree), H6 (random forest) with
    the reference's settings, plus H7 re-aimed as a distributed
    multilayer perceptron (hidden layer 128)."""
    # Fixed values (the reference's settings): LR maxIter 30, regParam 0.08,
    # elastic net 0; DT depth 12, min 2 rows per node; RF 40 trees, depth 12,
    # sqrt feature subsets, seed 42.
    out = [
        ("logistic_regression", LogisticRegression(featuresCol="features", labelCol="label", maxIter=30,
                                                   regParam=0.08, elasticNetParam=0.0, family="multinomial")),
        ("decision_tree", DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=12,
                                                 minInstancesPerNode=2, seed=seed)),
        ("random_forest", RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=40,
                                                 maxDepth=12, featureSubsetStrategy="sqrt", seed=seed)),
    ]
    if include_mlp:
        out.append(("multilayer_perceptron",
                    MultilayerPerceptronClassifier(featuresCol="features", labelCol="label",
                                                   layers=[n_features, 128, n_classes], maxIter=100,
                                                   blockSize=128, seed=seed)))
    return out


@dataclass
class Comparison:
    results: DataFrame
    models: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)


class _Timed:
    """What a step gave, or how it failed, and its seconds."""

    def __init__(self, step, *args):
        began = time.perf_counter()
        self.value, self.error = None, None
        try:
            self.value = step(*args)
        except Exception as exc:  # kept: the other models go on
            self.error = f"{FAILED}: {exc}"
        self.seconds = round(time.perf_counter() - began, 3)


#: Status word of a model that did not get through (fixed value).
FAILED = "failed"


def count_predictions(val: DataFrame, models: dict[str, object]) -> list:
    """D10 for many models in one pass over ``val``: rows (model, label, prediction,
    count), classes^2 a model. Only predictions are computed; a model's other
    outputs are switched off."""
    names, rows = list(models), val
    for i, name in enumerate(names):
        model = models[name]
        own = {model.predictionCol: f"_p{i}"}
        own |= {getattr(model, c): "" for c in ("probabilityCol", "rawPredictionCol") if model.hasParam(c)}
        rows = model.copy(own).transform(rows)
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"_p{i}").alias("prediction"))
                                  for i, n in enumerate(names)]))
    return ev.label_prediction_counts(rows.select("label", stacked.alias("p")).select("label", "p.*"), by=["model"]).collect()


def _evaluated(val: DataFrame, models: dict[str, object]) -> dict[str, _Timed]:
    """Each model's counts. All share one pass, whose seconds are split evenly;
    where that fails, each is tried alone, so that only the broken ones fail."""
    if not models:
        return {}
    whole = _Timed(count_predictions, val, models)
    if whole.error and len(models) > 1:
        return {n: _Timed(count_predictions, val, {n: m}) for n, m in models.items()}
    share, found = round(whole.seconds / len(models), 3), {}
    for n in models:
        found[n] = _Timed(lambda name=n: [r for r in whole.value if r["model"] == name])
        found[n].error, found[n].seconds = whole.error, share
    return found


def compare_models(spark: SparkSession, train: DataFrame, val: DataFrame,
                   classifiers: Sequence[tuple[str, object]], persist_input: bool = True,
                   parallelism: int = 1) -> Comparison:
    """H8: fit each estimator on ``train``, then count the predictions of all
    fitted ones on ``val`` in one pass; the metrics of the table come from these
    counts. A model that fails in either step has a ``failed: ...`` row of zeros.

    Both sides are persisted meanwhile: every fit reads one, the pass the other.
    ``parallelism > 1`` submits the fits from that many driver threads (as
    MLlib's CrossValidator does); their seconds then overlap and can't be set
    against those of sequential runs. ``eval_s`` is an even share of the one pass.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel

    if persist_input:
        train, val = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (train, val))
        val.count()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fits = dict(zip([n for n, _ in classifiers], pool.map(lambda c: _Timed(c[1].fit, train), classifiers)))
        judged = _evaluated(val, {n: f.value for n, f in fits.items() if not f.error})
    finally:
        if persist_input:
            train.unpersist()
            val.unpersist()
    models = {n: fits[n].value for n, j in judged.items() if not j.error}
    schema = "model string, label int, prediction int, count long"
    found = spark.createDataFrame([tuple(r) for n in models for r in judged[n].value], schema)
    facts = []
    for ordinal, (n, fit) in enumerate(fits.items()):
        evaluation = judged.get(n)
        status = fit.error or (evaluation and evaluation.error) or "ok"
        facts.append((n, ordinal, fit.seconds, evaluation.seconds if evaluation else 0.0, status))
    facts = spark.createDataFrame(facts, "model string, ordinal int, train_s double, eval_s double, status string")
    metrics = ("accuracy", "f1", "weighted_precision", "weighted_recall")
    table = facts.join(ev.overall_metrics(found, by=["model"]), "model", "left").select(
        "model", "ordinal", *[F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c) for c in metrics], "train_s", "eval_s", "status")
    # a row a model
    results = spark.createDataFrame(sorted(table.collect(), key=lambda r: r["ordinal"]), RESULT_SCHEMA)
    counts = {n: spark.createDataFrame([tuple(r)[1:] for r in judged[n].value], schema.partition(", ")[2]) for n in models}
    return Comparison(results, models, counts)


def write_reports(spark: SparkSession, comp: Comparison, root: str, classes: Sequence[int]) -> None:
    """Confusion matrix (wide), class metrics and comparison table."""
    if comp.results.isEmpty():
        return
    comp.results.write.mode("overwrite").parquet(f"{root}/model_comparison")
    for name, c in comp.counts.items():
        ev.confusion_wide(ev.confusion_long(spark, c, classes), classes) \
          .write.mode("overwrite").option("header", "true").csv(f"{root}/confusion_matrix_{name}")
        ev.class_metrics(c, classes, spark).write.mode("overwrite").option("header", "true") \
          .csv(f"{root}/class_metrics_{name}")


class QualityGateError(RuntimeError):
    pass


def publish_best(spark: SparkSession, comp: Comparison, prep_model: PipelineModel | None, root: str,
                 min_accuracy: float = 0.0) -> dict:
    """E5 + H9 + A21: pick the best row, check it against ``min_accuracy``
    *before* publishing, save one PipelineModel (preparation + classifier),
    then announce it (``tabula.sources.versions``): a rejected or half-written
    model is never the one readers resolve."""
    best = ev.pick_best(comp.results)
    if best["accuracy"] < min_accuracy:
        raise QualityGateError(f"accuracy {best['accuracy']:.4f} is below the required {min_accuracy:.4f}")
    stages = (list(prep_model.stages) if prep_model is not None else []) + [comp.models[best["model"]]]
    versions.publish(spark, root, lambda path: PipelineModel(stages=stages).write().save(path), model=best["model"])
    return best


#: Environment variable that names a model's path.
MODEL_PATH_VARIABLE = "TABULA_MODEL_PATH"


def resolve_model(spark: SparkSession, root: str | None = None, path: str | None = None) -> tuple[str, str]:
    """Name and path of a model: an explicit ``path``, else the path in the
    environment, else the newest one published under ``root`` (whatever kind). A path that is named but missing is an error."""
    for where in (path, os.environ.get(MODEL_PATH_VARIABLE)):
        if where:
            if not path_exists(spark, where):
                raise FileNotFoundError(f"no model at {where}")
            return where.rstrip("/").rsplit("/", 1)[-1], where
    version = versions.newest(spark, root) if root else None
    if version is None:
        raise FileNotFoundError(f"no model published under {root}")
    where = versions.version_path(root, version)
    if not path_exists(spark, where):
        raise FileNotFoundError(f"the newest published model is gone: {where}")
    return versions.facts(spark, root, version)["model"], where


def load_best(spark: SparkSession, root: str | None = None, path: str | None = None) -> tuple[str, PipelineModel]:
    """The resolved model's name and the model."""
    name, where = resolve_model(spark, root, path)
    return name, PipelineModel.load(where)


def timed(fn, *args, **kwargs):
    """Wall time of an action on the driver."""
    t0 = time.perf_counter()
    out = fn(*args, **kwargs)
    return out, time.perf_counter() - t0


def training_sample(df: DataFrame, fraction: float, key_col: str) -> DataFrame:
    """F3 applied to training input (content-hash form, partition-independent)."""
    from tabula.operators.split import hash_sample

    return hash_sample(df, F.col(key_col), fraction) if fraction < 1 else df
