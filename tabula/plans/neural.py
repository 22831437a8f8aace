"""H7: the neural classifier, trained epoch by epoch (with E6, A20, A21, H9).

An epoch is a fit of ``passes`` optimiser steps that begins with the weights of
the epoch before. After each one a single pass over the validation side gives
its loss, accuracy and confusion counts. Training really stops once ``patience``
epochs in a row brought no better accuracy, and the weights of the best epoch
are the model. The driver holds two sets of weights (bounded by the layers),
the fits and the evaluation run on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabula.operators import evaluate as ev
from tabula.plans.models import RESULT_SCHEMA, Comparison, publish_best
from tabula.sources.tables import write_metrics_json

#: Accuracy that a neural run must reach to be published (the reference's default).
NEURAL_GATE = 0.98
#: Epochs without a better accuracy before training stops (the reference's value).
PATIENCE = 3
NAME = "multilayer_perceptron"
HISTORY = "epoch int, train_loss double, validation_loss double, validation_accuracy double"


@dataclass
class EpochRun:
    """The best epoch's model and counts, and the history of all epochs."""

    model: object
    best_epoch: int
    history: DataFrame
    counts: DataFrame
    train_rows: int
    validation_rows: int

    @property
    def epochs(self) -> int:
        return self.history.count()


def judge(model, val: DataFrame) -> tuple[float, float, list]:
    """Validation loss, accuracy and (label, prediction, count) rows, from one pass."""
    label = F.col("label").cast("int")
    own = F.try_element_at(vector_to_array("probability"), label + 1)
    loss = -F.log(F.greatest(F.coalesce(own, F.lit(0.0)), F.lit(ev.LEAST_PROBABILITY)))
    cells = (model.transform(val).select(label.alias("label"), F.col("prediction").cast("int").alias("prediction"), loss.alias("loss"))
             .groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count"), F.sum("loss").alias("loss")).collect())
    n = max(1, sum(c["count"] for c in cells))
    correct = sum(c["count"] for c in cells if c["label"] == c["prediction"])
    return sum(c["loss"] for c in cells) / n, correct / n, [(c["label"], c["prediction"], c["count"]) for c in cells]


def train_epochs(spark: SparkSession, train: DataFrame, val: DataFrame, layers: list[int], epochs: int = 20, passes: int = 10,
                 patience: int = PATIENCE, seed: int = 42) -> EpochRun:
    """Fit a perceptron of ``layers`` (features and label columns) for up to ``epochs``."""
    if epochs < 1 or passes < 1 or patience < 1:
        raise ValueError("epochs, passes and patience must be positive")
    train, val = (d.persist(StorageLevel.MEMORY_AND_DISK) for d in (train, val))
    try:
        sides = train.count(), val.count()
        weights, best, history = None, None, []
        for epoch in range(1, epochs + 1):
            estimator = MultilayerPerceptronClassifier(featuresCol="features", labelCol="label", layers=layers, maxIter=passes,
                                                       blockSize=128, seed=seed)
            if weights is not None:
                estimator.setInitialWeights(weights)
            model = estimator.fit(train)
            weights = model.weights
            loss, accuracy, cells = judge(model, val)
            history.append((epoch, float(model.summary().objectiveHistory[-1]), loss, accuracy))
            if best is None or accuracy > best[0]:
                best = accuracy, epoch, model, cells
            elif epoch - best[1] >= patience:
                break
    finally:
        train.unpersist()
        val.unpersist()
    _, at, model, cells = best
    return EpochRun(model, at, spark.createDataFrame(history, HISTORY),
                    spark.createDataFrame(cells, "label int, prediction int, count long"), *sides)


def neural_run(spark: SparkSession, train: DataFrame, val: DataFrame, n_features: int, n_classes: int, root: str,
               prep_model: PipelineModel | None = None, min_accuracy: float = NEURAL_GATE, patience: int = PATIENCE,
               epochs: int = 20, passes: int = 10) -> EpochRun:
    """Train, write the metrics document (A20) with the history and the class
    metrics of the best epoch, and publish that epoch's model behind the gate (H9)."""
    import time

    began = time.perf_counter()
    run = train_epochs(spark, train, val, [n_features, 128, n_classes], epochs, passes, patience)
    seconds = time.perf_counter() - began
    found = ev.overall_metrics(run.counts).first()
    metrics = ("accuracy", "f1", "weighted_precision", "weighted_recall")
    summary = {"model": NAME, "train_samples": run.train_rows, "validation_samples": run.validation_rows,
               "best_validation_accuracy": found["accuracy"], "best_epoch": run.best_epoch, "epochs_completed": run.epochs,
               "passes_per_epoch": passes, **{m: found[m] for m in metrics}}
    root = root.rstrip("/")
    write_metrics_json(spark, f"{root}/{NAME}_metrics", summary, history=run.history, class_metrics=ev.class_metrics(run.counts))
    row = (NAME, 0, *[round(found[m], 6) for m in metrics], round(seconds, 3), 0.0, "ok")
    publish_best(spark, Comparison(spark.createDataFrame([row], RESULT_SCHEMA), {NAME: run.model}, {NAME: run.counts}), prep_model,
                 f"{root}/models", min_accuracy)
    return run
