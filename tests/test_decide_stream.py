"""Decisions inside the stream against the batch answer."""

import collections
import random

from pyspark.sql import functions as F

from tabula.operators.decide import group_analysis
from tabula.streaming import decide_stream as ds

SCHEMA = "id long, grp string, position int, at timestamp, embedding array<double>"


def digits(rng, groups=60):
    """Whole, cut, repeated, far and late groups, one of them with a third of all rows."""
    rows = []
    for g in range(groups):
        t = 1_700_000_000 + g
        kept = [(p, t + p) for p in range(1, 6)]
        if g % 6 == 1:
            kept = kept[:3]
        if g % 6 == 2:
            kept.append(kept[1])
        if g % 6 == 3:
            kept[4] = (70, t)
        if g % 6 == 4:
            kept[0] = (None, t)
        rows += [(f"g{g}", p, t) for p, t in kept]
    rows += [("hot", rng.randint(1, 5), 1_700_000_000 + rng.randint(0, 60)) for _ in range(len(rows) // 2)]
    rows += [(None, p, 1_700_000_000 + p) for p in range(1, 6)]
    return [(i, g, p, t, [rng.gauss(0, 3) for _ in range(10)]) for i, (g, p, t) in enumerate(rows)]


def write_files(spark, path, rows, files):
    for k in range(files):
        part = rows[k::files]
        spark.createDataFrame(part, "id long, grp string, position int, at long, embedding array<double>").withColumn(
            "at", F.timestamp_seconds("at")).coalesce(1).write.mode("append").parquet(f"{path}/digits.parquet")


def batch_answer(spark, path):
    from tabula.plans.score import score_logits

    scored = score_logits(spark.read.parquet(f"{path}/digits.parquet"), "embedding", "id", carry=("grp", "position"))
    out = group_analysis(scored, "grp")
    return out.withColumn("decision", F.coalesce("decision", F.lit("review"))).withColumn(
        "decision_label", F.coalesce("decision_label", F.lit(ds.REVIEW_LABEL)))


def answers(df):
    return collections.Counter((r.grp, *(r[c] for c in ds.RESULTS)) for r in df.collect())


def test_split_groups_give_the_batch_answer_also_after_a_restart(spark, tmp_path):
    rng = random.Random(2)
    rows = digits(rng)
    rng.shuffle(rows)
    path, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    half = len(rows) // 2
    run = lambda: ds.run_decision_stream(spark, path, "digits", "grp", "position", "at", "id", out, check,
                                         max_files_per_trigger=1)
    write_files(spark, path, rows[:half], 3)
    first = run()
    assert answers(first) == answers(batch_answer(spark, path))
    write_files(spark, path, rows[half:], 3)  # the same query goes on with its state
    again = run()
    assert answers(again) == answers(batch_answer(spark, path))
    assert again.filter("decision = 'auto'").count() + again.filter("decision = 'review'").count() == again.count() == 62
    assert answers(run()) == answers(again)  # nothing new: the same answer


def test_incomplete_groups_time_out_to_review(spark, tmp_path):
    path, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    sure = [5.0] + [-50.0] * 9
    early = [(i, "early", p, 1_700_000_000, sure) for i, p in enumerate((1, 2, 3))]
    whole = [(10 + p, "whole", p, 1_700_000_000, sure) for p in range(1, 6)]
    later = [(20 + p, "later", p, 1_700_090_000, sure) for p in range(1, 6)]
    last = [(30, "last", 1, 1_700_180_000, sure)]
    run = lambda: ds.run_decision_stream(spark, path, "digits", "grp", "position", "at", "id", out, check, drain=False,
                                         max_files_per_trigger=1)
    write_files(spark, path, early + whole, 1)
    got = {r.grp: r for r in run().collect()}
    assert set(got) == {"whole"} and got["whole"].decision == "auto" and got["whole"].postal_code == "00000"
    write_files(spark, path, later, 1)
    run()
    write_files(spark, path, last, 1)
    got = {r.grp: r for r in run().collect()}
    assert set(got) == {"whole", "later", "early"}  # "last" still waits
    assert got["early"].timed_out and not got["early"].valid and got["early"].decision == "review"
    assert got["early"].n_predictions == 3 and not got["later"].timed_out
    left = ds.leftover(spark, check, "grp").collect()
    assert [(r.grp, r.n_predictions, r.decision) for r in left] == [("last", 1, "review")]


def test_empty_source(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/digits.parquet")
    assert ds.run_decision_stream(spark, path, "digits", "grp", "position", "at", "id").count() == 0


def test_a_summary_passes_through_the_state_as_one_text(spark):
    stream = spark.readStream.format("rate").load().select(
        F.col("value").alias("grp"), F.lit(1).alias("position"), F.lit(2).alias("digit"), F.lit(0.5).alias("confidence"),
        F.col("timestamp").alias("at"))
    plan = ds.decided(stream, "grp", "at")._jdf.queryExecution().analyzed().toString()
    state = next(line for line in plan.splitlines() if "FlatMapGroupsInPandasWithState" in line)
    assert "told#" in state and "n_predictions#" not in state.split("[grp#")[1]
    one = (*ds.summary(2, 7, float("inf"), 10, 5)[:9], float("nan"), *ds.summary(2, 7, 0.1 + 0.2, 10, 5)[10:])
    back = ds.unpacked(ds.packed(one))
    assert back == (*one[:9], None, *one[10:]) and back[8] == float("inf") and back[10] == 0.1 + 0.2
