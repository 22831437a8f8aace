"""The result store against sets of keys."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from tabula.plans.result_store import ResultStore

SCHEMA = "memo_key string, value int"


def key(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def rows(spark, ids, value=0):
    return spark.createDataFrame([(key(i), value) for i in ids], SCHEMA)


def asked(spark, ids):
    return spark.createDataFrame([(i, None if i is None else key(i)) for i in ids], "id long, memo_key string")


def test_pending_is_exact_through_appends_and_compaction(spark, tmp_path):
    store, known = ResultStore(spark, str(tmp_path / "s"), SCHEMA), set()
    question = asked(spark, [*range(400), 5, 5, None])

    def check():
        got = collections.Counter(r["id"] for r in store.pending(question).collect())
        want = collections.Counter(i for i in [*range(400), 5, 5, None] if i not in known)
        assert got == want

    check()  # an empty store
    for k in range(3):
        part = [i for i in range(1000) if i % 5 == k or i < 10]
        store.append(rows(spark, part, k))
        known |= set(part)
        check()
    assert len(store.parts()) == 3
    first = store.results()
    assert first.count() == len(known)
    store.compact()
    assert len(store.parts()) == 1
    check()
    # the first part's result stays
    found = {r["memo_key"]: r["value"] for r in store.results().collect()}
    assert found == {r["memo_key"]: r["value"] for r in first.collect()} and found[key(3)] == 0 and found[key(12)] == 2
    store.append(rows(spark, [377, 378], 9))
    known |= {377, 378}
    check()
    assert len(store.vacuum(grace_s=0)) == 3
    check()
    assert store.results().count() == len(known)


def test_an_append_during_a_compaction_stays(spark, tmp_path):
    one, other = (ResultStore(spark, str(tmp_path / "s"), SCHEMA) for _ in range(2))
    one.append(rows(spark, range(5)))
    before = one.parts()
    other.append(rows(spark, range(5, 8)))
    one._write(rows(spark, range(5)), 1, before)  # a compaction that saw the first part only
    assert one.results().count() == 8 and one.pending(asked(spark, range(10))).count() == 2


def test_filters_rule_out_most_new_keys(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), SCHEMA)
    store.append(rows(spark, range(20_000)))
    new = spark.createDataFrame([(key(i),) for i in range(20_000, 24_000)], "memo_key string")
    assert store.maybe(new).count() < 40
    old = spark.createDataFrame([(key(i),) for i in range(500)], "memo_key string")
    assert store.maybe(old).count() == 500


def test_only_touched_prefixes_are_read(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), SCHEMA)
    store.append(rows(spark, range(2000)))
    some = spark.createDataFrame([(key(1),), (key(2),), (key(-1),)], "memo_key string")
    touched = store.touched(some)
    assert len(touched) <= 3
    held = store._rows(store.parts()).filter(F.col("prefix").isin(touched))
    plan = store.stored(some)._jdf.queryExecution().toString()
    assert any("PartitionFilters" in line and "prefix#" in line.split("PartitionFilters")[1] for line in plan.splitlines())
    read = {r[0].rsplit("prefix=")[-1].split("/")[0] for r in held.select(F.input_file_name()).distinct().collect()}
    assert read <= set(touched) and len(read) <= 3
    assert sorted(r[0] for r in store.stored(some).collect()) == sorted([key(1), key(2)])


def test_schema_needs_the_key(spark, tmp_path):
    with pytest.raises(ValueError):
        ResultStore(spark, str(tmp_path / "s"), "value int")
