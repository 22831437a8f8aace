"""Golden checks: the reference's published confusion matrices through our
metric operators must give its published metrics (copied here as literals)."""

import pytest
from pyspark.sql import functions as F

from tabula.operators import evaluate as ev

# Published confusion matrices (rows = actual 0..9, columns = predicted 0..9).
LR = [
    [153, 0, 1, 2, 0, 2, 0, 1, 1, 1],
    [0, 168, 0, 0, 1, 3, 0, 0, 1, 0],
    [1, 4, 143, 4, 4, 2, 5, 8, 7, 1],
    [0, 1, 5, 154, 0, 4, 1, 4, 0, 5],
    [0, 1, 1, 0, 155, 1, 2, 0, 2, 15],
    [3, 3, 2, 15, 8, 104, 3, 0, 3, 3],
    [1, 0, 1, 0, 4, 2, 146, 0, 1, 0],
    [2, 4, 3, 2, 2, 0, 0, 142, 0, 7],
    [0, 12, 4, 10, 2, 4, 1, 0, 129, 4],
    [3, 0, 1, 2, 7, 1, 0, 4, 2, 129],
]
DT = [
    [140, 1, 5, 2, 2, 4, 0, 2, 4, 1],
    [1, 164, 1, 2, 0, 2, 0, 0, 1, 2],
    [10, 3, 126, 11, 7, 3, 3, 3, 9, 4],
    [3, 1, 5, 143, 1, 8, 2, 1, 8, 2],
    [0, 2, 2, 4, 138, 3, 5, 3, 1, 19],
    [9, 1, 7, 14, 4, 84, 3, 1, 20, 1],
    [4, 2, 4, 9, 5, 2, 124, 0, 5, 0],
    [2, 3, 7, 3, 4, 4, 0, 126, 2, 11],
    [1, 5, 10, 11, 4, 12, 2, 1, 118, 2],
    [2, 2, 4, 1, 13, 4, 1, 12, 4, 106],
]
RF = [
    [153, 0, 1, 1, 0, 1, 0, 0, 3, 2],
    [0, 171, 1, 1, 0, 0, 0, 0, 0, 0],
    [2, 2, 144, 9, 2, 0, 3, 6, 10, 1],
    [0, 0, 5, 158, 0, 2, 0, 3, 3, 3],
    [1, 2, 2, 0, 157, 1, 2, 0, 3, 9],
    [2, 0, 2, 11, 2, 119, 2, 0, 3, 3],
    [0, 1, 5, 2, 1, 2, 143, 0, 1, 0],
    [0, 1, 4, 0, 2, 0, 0, 150, 2, 3],
    [0, 2, 3, 9, 2, 4, 0, 0, 143, 3],
    [3, 0, 1, 0, 7, 1, 0, 6, 4, 127],
]
CNN = [
    [851, 0, 0, 0, 0, 0, 1, 0, 1, 0],
    [0, 924, 8, 0, 0, 0, 1, 6, 0, 0],
    [0, 0, 783, 1, 1, 0, 0, 5, 2, 0],
    [1, 0, 0, 859, 0, 3, 0, 3, 3, 3],
    [0, 2, 1, 0, 808, 0, 2, 2, 0, 12],
    [1, 0, 1, 7, 0, 750, 2, 0, 2, 1],
    [5, 0, 0, 0, 0, 1, 824, 0, 1, 0],
    [0, 0, 4, 0, 2, 0, 0, 884, 1, 0],
    [0, 2, 4, 0, 2, 2, 2, 3, 813, 8],
    [0, 0, 0, 2, 1, 0, 0, 9, 2, 788],
]
# Published (accuracy, f1, weighted_precision, weighted_recall)
PUBLISHED = {
    "LR": (0.867683, 0.866648, 0.869038, 0.867683),
    "DT": (0.77378, 0.772748, 0.774177, 0.77378),
    "RF": (0.893293, 0.893139, 0.894176, 0.893293),
}
RF_F1 = [0.9503, 0.9716, 0.8300, 0.8658, 0.8971, 0.8686, 0.9377, 0.9174, 0.8462, 0.8467]
CNN_F1 = [0.9947, 0.9898, 0.9831, 0.9868, 0.9848, 0.9868, 0.9910, 0.9806, 0.9789, 0.9765]


def counts_df(spark, matrix, by=None):
    rows = [(a, p, c) for a, r in enumerate(matrix) for p, c in enumerate(r) if c]
    df = spark.createDataFrame(rows, "label int, prediction int, count bigint")
    return df.withColumn("model", F.lit(by)) if by else df


@pytest.mark.parametrize("name,matrix", [("LR", LR), ("DT", DT), ("RF", RF)])
def test_overall_metrics_golden(spark, name, matrix):
    m = ev.overall_metrics(counts_df(spark, matrix)).first()
    got = tuple(round(m[k], 6) for k in ("accuracy", "f1", "weighted_precision", "weighted_recall"))
    assert got == pytest.approx(PUBLISHED[name], abs=1e-6)
    assert m["n"] == 1640


def test_class_metrics_golden(spark):
    rf = {r["label"]: r for r in ev.class_metrics(counts_df(spark, RF), range(10), spark).collect()}
    assert [round(rf[k]["f1"], 4) for k in range(10)] == RF_F1
    assert rf[1]["recall"] == pytest.approx(0.9884393063583815, abs=1e-12)
    cnn = {r["label"]: r for r in ev.class_metrics(counts_df(spark, CNN), range(10), spark).collect()}
    assert [round(cnn[k]["f1"], 4) for k in range(10)] == CNN_F1
    acc = ev.overall_metrics(counts_df(spark, CNN)).first()["accuracy"]
    assert acc == pytest.approx(0.9853693350779112, abs=1e-12)


def test_many_models_one_pass(spark):
    df = counts_df(spark, LR, "lr").unionByName(counts_df(spark, RF, "rf"))
    out = {r["model"]: r for r in ev.overall_metrics(df, by=["model"]).collect()}
    assert round(out["lr"]["accuracy"], 6) == PUBLISHED["LR"][0]
    assert round(out["rf"]["f1"], 6) == PUBLISHED["RF"][1]


def test_confusion_dense_and_wide(spark):
    c = counts_df(spark, [[2, 0], [0, 0]])  # class 1 never appears
    dense = ev.confusion_long(spark, c, [0, 1, 2])
    assert dense.count() == 9
    assert dense.filter("count > 0").count() == 1
    wide = {r["label"]: r for r in ev.confusion_wide(dense, [0, 1, 2]).collect()}
    assert wide[0]["0"] == 2 and wide[2]["2"] == 0


def test_zero_denominators(spark):
    c = spark.createDataFrame([(0, 1, 5)], "label int, prediction int, count bigint")
    m = {r["label"]: r for r in ev.class_metrics(c, [0, 1, 2], spark).collect()}
    assert m[0]["precision"] == 0.0 and m[0]["recall"] == 0.0 and m[0]["f1"] == 0.0
    assert m[2]["support"] == 0


def test_classes_outside_the_list_are_counted(spark):
    c = spark.createDataFrame([(0, 0, 3), (12, 0, 4), (12, 13, 2), (1, None, 1)], "label int, prediction int, count bigint")
    dense = ev.confusion_long(spark, c, range(10))
    cells = {(r["label"], r["prediction"]): r["count"] for r in dense.collect()}
    assert len(cells) == 103 and sum(cells.values()) == 10
    assert (cells[0, 0], cells[-1, 0], cells[-1, -1], cells[1, -1]) == (3, 4, 2, 1)
    wide = {r["label"]: r for r in ev.confusion_wide(dense, range(10)).collect()}
    assert wide[-1]["0"] == 4 and wide[-1]["other"] == 2 and wide[1]["other"] == 1 and len(wide) == 11
    m = {r["label"]: r for r in ev.class_metrics(c.dropna(), range(10), spark).collect()}
    assert m[12]["support"] == 6 and m[13]["support"] == 0 and len(m) == 12
    own = ev.confusion_long(spark, c.dropna())
    assert own.count() == 9 and own.agg(F.sum("count")).first()[0] == 9


def test_log_loss_of_a_certain_miss(spark):
    import math

    pred = spark.createDataFrame([(0, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (5, 0, [1.0, 0.0])],
                                 "label int, prediction int, probability array<double>")
    assert ev.log_loss(pred).first()["loss"] == pytest.approx(-2 * math.log(1e-15) / 3)


def test_log_loss_and_empty(spark):
    pred = spark.createDataFrame([(0, 0, [0.5, 0.5]), (1, 0, [0.75, 0.25])],
                                 "label int, prediction int, probability array<double>")
    r = ev.log_loss(pred).first()
    import math
    assert r["loss"] == pytest.approx((-math.log(0.5) - math.log(0.25)) / 2)
    assert r["accuracy"] == 0.5
    empty = ev.log_loss(pred.limit(0)).first()
    assert empty["loss"] == 0.0 and empty["accuracy"] == 0.0


def test_best_row_ties_and_failures(spark):
    res = spark.createDataFrame(
        [("a", 0, 0.9, 0.8, "ok"), ("b", 1, 0.95, 0.8, "ok"), ("c", 2, 0.95, 0.8, "ok"), ("d", 3, 1.0, 1.0, "failed: x")],
        "model string, ordinal int, accuracy double, f1 double, status string")
    assert ev.pick_best(res)["model"] == "b"
    with pytest.raises(RuntimeError):
        ev.pick_best(res.filter("status != 'ok'"))


def test_early_stopping_published_history(spark):
    acc = [0.9568, 0.9697, 0.9768, 0.9807, 0.9839, 0.9844, 0.9836, 0.9842, 0.9845, 0.9854]
    h = spark.createDataFrame([(1, e, a) for e, a in enumerate(acc, 1)], "run int, epoch int, accuracy double")
    rows = ev.early_stopping(h, ["run"], patience=3).orderBy("epoch").collect()
    assert len(rows) == 10 and rows[-1]["best_epoch"] == 10 and rows[-1]["stop_epoch"] is None
    assert [r["improved"] for r in rows][6:8] == [False, False]


def test_early_stopping_stops(spark):
    acc = [0.5, 0.6, 0.6, 0.55, 0.59, 0.9]
    h = spark.createDataFrame([(1, e, a) for e, a in enumerate(acc, 1)], "run int, epoch int, accuracy double")
    rows = ev.early_stopping(h, ["run"], patience=3).orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == [1, 2, 3, 4, 5]  # equal is not better
    assert rows[-1]["stopped_here"] and rows[-1]["best_epoch"] == 2
