import pytest
from pyspark.sql import functions as F

from tabula.plans.score import ScorerConfigurationError, get_scorer, memo_key, pending, score_logits
from tabula.streaming.score_stream import run_scoring_stream

from paths import SF_SMALL


def test_softmax_digits_from_fixed_logits(spark):
    rows = []
    for i, c in enumerate([9, 3, 4, 0, 0]):
        v = [0.0] * 10
        v[c] = 4.0
        rows.append((i, v))
    df = spark.createDataFrame(rows, "id long, logits array<float>")
    out = score_logits(df, "logits", "id").orderBy("id").collect()
    assert [r["digit"] for r in out] == [9, 3, 4, 0, 0]
    import math
    expect = math.exp(4) / (math.exp(4) + 9)
    assert all(abs(r["confidence"] - expect) < 1e-12 and r["valid"] for r in out)


def test_scorer_selection(spark):
    assert get_scorer("  LOGITS ", logits_col="logits")
    with pytest.raises(ScorerConfigurationError):
        get_scorer("spark")  # no model
    with pytest.raises(ScorerConfigurationError):
        get_scorer("demo")


def test_key_carried_when_rows_come_back_reversed(spark):
    rows = [(p, [0.0] * d + [5.0] + [0.0] * (9 - d)) for p, d in [(4, 5), (3, 1), (2, 4), (1, 1), (0, 3)]]
    df = spark.createDataFrame(rows, "_position int, logits array<double>").orderBy(F.col("_position").desc())
    got = {r["_position"]: r["digit"] for r in score_logits(df, "logits", "_position").collect()}
    assert [got[i] for i in range(5)] == [3, 1, 4, 1, 5]


def test_memo_and_pending(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    keyed = docs.select("doc_id", memo_key(F.col("text"), "m1", False).alias("memo_key"))
    scored = keyed.filter("doc_id = 1").select("memo_key")
    assert sorted(r.doc_id for r in pending(keyed, scored).collect()) == [2]  # 3 has the same content as 1
    other = docs.select("doc_id", memo_key(F.col("text"), "m2", False).alias("memo_key"))
    assert pending(other, scored).count() == 3  # another model -> stale results unused


def test_stream_equals_batch(spark):
    streamed = run_scoring_stream(spark, SF_SMALL, "embeddings")
    batch = score_logits(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"), "embedding", "vec_id").drop("probability")
    assert streamed.count() == batch.count() == 500
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0


def test_stream_of_a_table_of_many_files(spark, tmp_path):
    batch = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    batch.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    streamed = run_scoring_stream(spark, str(tmp_path), "embeddings")
    want = score_logits(batch, "embedding", "vec_id").drop("probability")
    assert streamed.count() == 500 and streamed.select(want.columns).exceptAll(want).count() == 0
