"""Classifier evaluation from one ``(label, prediction)`` count table
(D10-D14, C3, E5, E6, A16-A18, K8).

The only pass over the predictions is ``label_prediction_counts``: a
grouped count with map-side partial aggregation, so the shuffle carries at
most classes^2 rows per task. Every metric is derived from that small table
with further DataFrame operations (no collect). ``by`` columns evaluate many
experiments (models, epochs, folds) in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def label_prediction_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                            by: Sequence[str] = ()) -> DataFrame:
    """``(by..., label, prediction, count)`` with integer classes."""
    return (pred.select(*by, F.col(label).cast("int").alias("label"),
                        F.col(prediction).cast("int").alias("prediction"))
                .groupBy(*by, "label", "prediction").agg(F.count(F.lit(1)).alias("count")))


def _cells(classes: Sequence[int]) -> Column:
    cls = [int(c) for c in classes]
    return F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction")) for a in cls for b in cls])


#: Cell of labels and predictions outside a given list of classes.
OTHER = -1


def confusion_long(spark: SparkSession, counts: DataFrame, classes: Sequence[int] | None = None,
                   by: Sequence[str] = ()) -> DataFrame:
    """Dense ``(by..., label, prediction, count)``; absent cells are 0.

    Without ``classes`` the grid is over the classes that occur. With a list,
    a label or prediction outside it is counted in the cell of ``OTHER``, which
    appears only where such rows exist, so no row is lost.

    The grid is exploded from the classes next to each experiment row (no
    cross join). The build side is the counts table (classes^2 rows per
    experiment), which AQE broadcasts by its measured size.
    """
    keys = [*by, "label", "prediction"]
    if classes is None:
        cell = lambda c: F.coalesce(c, F.lit(OTHER))
        found = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array(cell(F.col("label")), cell(F.col("prediction")))))))
        grid = (counts.groupBy(*by).agg(found.alias("c")).select(*by, F.explode("c").alias("label"), "c")
                .select(*by, "label", F.explode("c").alias("prediction")))
    else:
        listed = [int(c) for c in classes]
        cell = lambda c: F.when(c.isin(listed), c).otherwise(F.lit(OTHER))
        if by:
            grid = counts.select(*by).distinct().select(*by, F.inline(_cells(listed)))
        else:
            grid = spark.range(1).select(F.inline(_cells(listed)))
    cells = (counts.select(*by, cell(F.col("label")).alias("label"), cell(F.col("prediction")).alias("prediction"), "count")
             .groupBy(*keys).agg(F.sum("count").alias("count")))
    # the cells of OTHER have no place in a listed grid: a full join keeps them
    return (grid.join(cells, keys, "full_outer")
            .select(*keys, F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def confusion_wide(confusion: DataFrame, classes: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """One row per actual class (and ``OTHER`` if it occurs), one column per
    predicted class ('0'..'9') and ``other`` for predictions outside the list."""
    names = [int(c) for c in classes]
    counted = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint")
    wide = confusion.groupBy(*by, "label").pivot("prediction", [*names, OTHER]).agg(F.sum("count"))
    return wide.select(*by, "label", *[counted(c).alias(str(c)) for c in names], counted(OTHER).alias("other"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_totals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per class: true positives, actual support and predicted total, in one
    aggregation (each count row contributes to its label and its prediction)."""
    parts = F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("actual"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0).cast("bigint").alias("tp")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("count").alias("predicted"), F.lit(0).cast("bigint").alias("tp")))
    return (counts.select(*by, F.inline(parts))
                  .groupBy(*by, "cls")
                  .agg(F.sum("tp").alias("tp"), F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted")))


def class_metrics(counts: DataFrame, classes: Sequence[int] | None = None,
                  spark: SparkSession | None = None, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., label, precision, recall, f1, support)``; zero
    denominators give 0.0. With ``classes`` the output is dense over them;
    classes that occur outside the list keep rows of their own."""
    t = class_totals(counts, by).withColumnRenamed("cls", "label")
    if classes is not None:
        assert spark is not None, "spark is needed to build the dense class list"
        labels = F.array(*[F.lit(int(c)) for c in classes])
        base = counts.select(*by).distinct() if by else spark.range(1).select()
        cls = base.select(*by, F.explode(labels).alias("label"))
        t = cls.join(t, [*by, "label"], "full_outer").na.fill(0, ["tp", "actual", "predicted"])
    p = _safe_div(F.col("tp"), F.col("predicted"))
    r = _safe_div(F.col("tp"), F.col("actual"))
    return (t.withColumn("precision", p).withColumn("recall", r)
             .withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
             .select(*by, "label", "precision", "recall", "f1", F.col("actual").cast("bigint").alias("support")))


def overall_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 over the
    classes that occur (as label or prediction), MLlib's definitions."""
    t = class_totals(counts, by)
    prec = _safe_div(F.col("tp"), F.col("predicted"))
    rec = _safe_div(F.col("tp"), F.col("actual"))
    f1 = _safe_div(2 * prec * rec, prec + rec)
    agg = t.groupBy(*by).agg(F.sum("actual").alias("n"), F.sum("tp").alias("correct"),
                             F.sum(F.col("actual") * prec).alias("wp"),
                             F.sum(F.col("actual") * rec).alias("wr"),
                             F.sum(F.col("actual") * f1).alias("wf"))
    return agg.select(*by, _safe_div(F.col("correct"), F.col("n")).alias("accuracy"),
                      _safe_div(F.col("wf"), F.col("n")).alias("f1"),
                      _safe_div(F.col("wp"), F.col("n")).alias("weighted_precision"),
                      _safe_div(F.col("wr"), F.col("n")).alias("weighted_recall"),
                      F.col("n").cast("bigint").alias("n"))


#: Smallest probability that a loss is taken of (a loss of 34.5 at most).
LEAST_PROBABILITY = 1e-15


def log_loss(pred: DataFrame, probs: str = "probability", label: str = "label",
             prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Mean cross-entropy of the true class and accuracy; an empty input
    gives 0 for both (the reference divides by max(count, 1)). A probability
    below ``LEAST_PROBABILITY``, or none for the label, counts as that, so the
    worst miss has the largest loss instead of none."""
    p_true = F.greatest(F.coalesce(F.try_element_at(F.col(probs), F.col(label).cast("int") + 1).cast("double"), F.lit(0.0)),
                        F.lit(LEAST_PROBABILITY))
    agg = pred.groupBy(*by).agg(F.sum(-F.log(p_true)).alias("loss_sum"),
                                F.sum((F.col(label).cast("int") == F.col(prediction).cast("int")).cast("int")).alias("correct"),
                                F.count(F.lit(1)).alias("n"))
    denom = F.greatest(F.col("n"), F.lit(1))
    return agg.select(*by, (F.coalesce(F.col("loss_sum"), F.lit(0.0)) / denom).alias("loss"),
                      (F.coalesce(F.col("correct"), F.lit(0)) / denom).alias("accuracy"), F.col("n"))


def best_row(results: DataFrame, by: Sequence[str] = (), order_col: str = "ordinal") -> DataFrame:
    """E5: among ``status = 'ok'`` rows, the highest rounded F1, then accuracy;
    ties keep the earliest ``ordinal``. One row per ``by`` group."""
    w = Window.partitionBy(*by).orderBy(F.round("f1", 6).desc(), F.round("accuracy", 6).desc(),
                                        F.col(order_col).asc()) if by else None
    ok = results.filter(F.col("status") == "ok")
    if w is None:
        return ok.orderBy(F.round("f1", 6).desc(), F.round("accuracy", 6).desc(), F.col(order_col).asc()).limit(1)
    return ok.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


class NoModelError(RuntimeError):
    """A comparison without a usable model."""


def pick_best(results: DataFrame, order_col: str = "ordinal") -> dict:
    """E5 driver-side form: the winning row as a dict; ``NoModelError`` with each
    model's status when there is none."""
    winner = best_row(results, order_col=order_col).first()
    if winner is None:
        states = {r["model"]: r["status"] for r in results.select("model", "status").collect()}
        raise NoModelError(f"nothing to choose from: {states}")
    return winner.asDict()


def early_stopping(history: DataFrame, by: Sequence[str], metric: str = "accuracy", epoch: str = "epoch",
                   patience: int = 3) -> DataFrame:
    """Per epoch, whether it improved strictly on every earlier epoch, the
    best epoch so far, and the count of epochs since the last improvement.
    Training stops at the first epoch where that count reaches ``patience``;
    later epochs are dropped. Windows are per experiment (``by``, at least one
    column), whose size is the epoch count."""
    if not by:
        raise ValueError("early_stopping needs the columns that name an experiment")
    w_prev = Window.partitionBy(*by).orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    w_upto = Window.partitionBy(*by).orderBy(epoch).rowsBetween(Window.unboundedPreceding, 0)
    h = history.withColumn("improved", F.coalesce(F.col(metric) > F.max(metric).over(w_prev), F.lit(True)))
    h = h.withColumn("best_epoch", F.max(F.when(F.col("improved"), F.col(epoch))).over(w_upto))
    h = h.withColumn("since_best", (F.col(epoch) - F.col("best_epoch")).cast("int"))
    h = h.withColumn("best_so_far", F.max(metric).over(w_upto))
    stop = F.min(F.when(F.col("since_best") >= patience, F.col(epoch))).over(
        Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    h = h.withColumn("stop_epoch", stop)
    return (h.filter(F.col("stop_epoch").isNull() | (F.col(epoch) <= F.col("stop_epoch")))
             .withColumn("stopped_here", F.coalesce(F.col(epoch) == F.col("stop_epoch"), F.lit(False))))


def comparison_report(results: DataFrame) -> DataFrame:
    """K8: the comparison table as display strings (4 / 2 decimals)."""
    return results.select(
        "model",
        *[F.format_number(F.col(c), 4).alias(c) for c in ("accuracy", "f1", "weighted_precision", "weighted_recall")],
        *[F.format_number(F.col(c), 2).alias(c) for c in ("train_s", "eval_s")],
        "status")
