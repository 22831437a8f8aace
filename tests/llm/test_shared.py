"""Components, intermediate tables and counted broadcasts."""

import random

import pytest
from helpers import roots

from tabula.llm.common import checked_broadcast, remove_intermediate, written
from tabula.llm.components import components
from tabula.session import scratch_path
from tabula.sources.tables import path_exists


@pytest.mark.parametrize("nodes,links", [
    (120, [(i, i + 1) for i in range(59)]), (80, [(0, k) for k in range(1, 80)]), (80, [(79, k) for k in range(79)]),
    (150, None), (60, [(5, 5), (1, 1)])])
def test_components(spark, nodes, links):
    rng = random.Random(nodes)
    links = links or [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(110)] * 2
    want = {n: r for n, r in enumerate(roots(nodes, links)) if any(n in e for e in links if e[0] != e[1])}
    got = components(spark, spark.createDataFrame(links, "a long, b long"), "test").collect()
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


def test_components_of_binary_names_and_of_nothing(spark):
    df = spark.createDataFrame([(b"c", b"a"), (b"b", b"c")], "a binary, b binary")
    assert {bytes(r.node): bytes(r.root) for r in components(spark, df, "test").collect()} == {b"a": b"a", b"b": b"a", b"c": b"a"}
    assert components(spark, df.limit(0), "test").count() == 0


def test_broadcast_only_of_counted_small_sides(spark):
    big, small = spark.range(1000), written(spark, spark.range(50), "test")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda limit: big.join(checked_broadcast(small, 8, limit), "id")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(400) and "BroadcastHashJoin" not in plan(399)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_intermediate_tables_can_be_removed(spark):
    assert written(spark, spark.range(3), "test").count() == 3
    assert path_exists(spark, scratch_path(spark, "llm"))
    remove_intermediate(spark)
    assert not path_exists(spark, scratch_path(spark, "llm"))
