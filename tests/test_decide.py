"""Decision-rule cases."""

from pyspark.sql import functions as F

from tabula.operators.decide import group_analysis


def analyse(spark, groups, threshold=0.8, n=5):
    rows = [(g, i + 1, d, c) for g, preds in groups.items() for i, (d, c) in enumerate(preds)]
    df = spark.createDataFrame(rows, "key string, position int, digit int, confidence double")
    return {r["key"]: r for r in group_analysis(df, "key", threshold=threshold, n=n).collect()}


def test_decisions(spark):
    out = analyse(spark, {
        "sure": [(7, 0.83), (0, 0.999), (4, 0.86), (4, 0.94), (2, 1.0)],
        "edge": [(1, 0.8), (1, 0.81), (1, 0.97), (1, 0.93), (1, 0.85)],
        "weak": [(9, 0.99), (8, 0.41), (7, 0.52), (6, 0.9), (5, 0.43)],
        "short": [(3, 0.95), (3, 0.96)],
    })
    sure, weak, short = out["sure"], out["weak"], out["short"]
    assert (sure["postal_code"], sure["decision"], sure["weakest_position"]) == ("70442", "auto", 1)
    assert abs(sure["global_confidence"] - 0.83) < 1e-12 and sure["review_reason"] is None
    assert out["edge"]["decision"] == "auto"  # the threshold itself passes
    assert (weak["decision"], weak["decision_label"], weak["weakest_position"]) == ("review", "Vérification humaine", 2)
    assert weak["review_reason"] == "Le chiffre en position 2 n'atteint que 41% de confiance."
    assert short["valid"] is False and all(short[c] is None for c in ("postal_code", "decision", "decision_label", "review_reason"))


def test_nulls_and_far_positions_are_invalid_not_errors(spark):
    good = [(p, p, 0.9) for p in range(1, 6)]
    groups = {"null digit": good[:4] + [(5, None, 0.9)], "null confidence": good[:4] + [(5, 1, None)],
              "null position": good[:4] + [(None, 1, 0.9)], "far": good[:4] + [(70, 1, 0.9)], "low": good[:4] + [(-3, 1, 0.9)],
              "good": good}
    df = spark.createDataFrame([(k, *r) for k, rows in groups.items() for r in rows],
                               "key string, position int, digit int, confidence double")
    out = {r["key"]: r for r in group_analysis(df, "key").collect()}
    assert out["good"]["valid"] and out["good"]["decision"] == "auto"
    for k in set(groups) - {"good"}:
        assert out[k]["valid"] is False and out[k]["decision"] is None and out[k]["postal_code"] is None, k


def test_half_even_percent_and_first_tie(spark):
    out = analyse(spark, {"g": [(1, 0.9), (2, 0.725), (3, 0.725), (4, 0.9), (5, 0.9)]})
    assert out["g"]["weakest_position"] == 2
    assert "72%" in out["g"]["review_reason"]  # 72.5 rounds half-to-even


def test_positions_not_row_order(spark):
    rows = [("k", p, d, 0.9) for p, d in [(5, 5), (3, 3), (1, 1), (4, 4), (2, 2)]]
    df = spark.createDataFrame(rows, "key string, position int, digit int, confidence double")
    r = group_analysis(df, "key").first()
    assert r["postal_code"] == "12345" and r["valid"]


def test_duplicate_position_invalid(spark):
    rows = [("k", p, 1, 0.9) for p in [1, 1, 2, 3, 4]]
    df = spark.createDataFrame(rows, "key string, position int, digit int, confidence double")
    assert group_analysis(df, "key").first()["valid"] is False


def test_out_of_range_invalid(spark):
    rows = [("k", p, 12 if p == 2 else 1, 0.9) for p in range(1, 6)]
    df = spark.createDataFrame(rows, "key string, position int, digit int, confidence double")
    assert group_analysis(df, "key").first()["valid"] is False


def test_hot_key_is_aggregated_not_collected(spark):
    # one key with many rows: still one output row, computed by bounded aggregates
    df = spark.range(200000).select(F.lit("hot").alias("key"), (F.col("id") % 5 + 1).cast("int").alias("position"),
                                     F.lit(3).alias("digit"), F.lit(0.9).alias("confidence"))
    r = group_analysis(df, "key").first()
    assert r["n_predictions"] == 200000 and r["valid"] is False
