import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from goldkeep.operators import joins, remap


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [True, False])
def test_attach_equals_the_plain_join(spark, join_path, how, null_safe):
    rng = random.Random(3)
    keys = [None, "hot", *"abcdefgh"]
    facts = [(i, "hot" if i % 3 == 0 else rng.choice(keys)) for i in range(600)]
    lookup = {k: n for n, k in enumerate(keys) if k not in ("g", "h")}
    left = spark.createDataFrame(facts, "i int, k string").repartition(5)
    right = spark.createDataFrame([(k, v) for k, v in lookup.items()], "key string, v int")
    got = joins.attach(left, right, {"k": "key"}, how=how, null_safe=null_safe)
    want = []
    for i, k in facts:
        hit = k in lookup and (null_safe or k is not None)
        if hit or how == "left":
            want.append((i, k, lookup[k] if hit else None))
    assert got.columns == ["i", "k", "v"]
    assert rows(got) == sorted(want, key=repr)


def test_attach_broadcasts_only_within_the_bound(spark):
    facts = spark.range(100).selectExpr("id % 5 as k")
    lookup = spark.range(1000).selectExpr("id as key", "id * 2 as v")
    assert joins.measured_bytes(lookup) >= 1000 * 16
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.attach(facts, lookup, {"k": "key"})
        large = joins.attach(facts, lookup, {"k": "key"}, broadcast_bytes=100)
        assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" not in plan(small)
        assert "SortMergeJoin" in plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(small) == rows(large)


def test_key_types_may_differ(spark, join_path):
    facts = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (None,)], "k int")
    lookup = spark.createDataFrame([(1, "a"), (2, "b")], "key long, v string")
    got = joins.attach(facts, lookup, {"k": "key"})
    assert rows(got) == sorted([(1, "a")] * 3 + [(2, "b"), (3, None), (None, None)], key=repr)


def test_heavy_rows_are_spread_over_tasks(spark, join_path):
    facts = spark.range(0, 8000, 1, 40).selectExpr("if(id % 3 < 2, 7, id) as k")
    lookup = spark.range(8000).selectExpr("id as key", "id * 2 as v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = joins.attach(facts, lookup, {"k": "key"})
        assert got.where("v = 2 * k").count() == 8000
        share = got.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["count"] for r in share) < 8000 / 3


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counting_heavy_keys_holds_no_join(spark, monkeypatch):
    """Keys of every column are counted on the facts as they come."""
    counted = []
    real = joins.settle
    monkeypatch.setattr(joins, "settle", lambda df: counted.append(plan(df)) or real(df))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    facts = spark.range(3000).selectExpr("id % 7 as a", "id % 11 as b", "id % 13 as c")
    walk = spark.createDataFrame([(1, 0), (8, 2)], "retired_id long, golden_id long")
    done = remap.remap_keys(facts, walk, ["a", "b", "c"])
    counts = [p for p in counted if "Aggregate" in p]
    assert len(counts) == 3 and not any("Join" in p for p in counts)
    assert done.where("a = 1 or b = 1 or b = 8 or c = 1 or c = 8").count() == 0


def test_heavy_keys_of_several_columns(spark):
    facts = spark.createDataFrame([(1, "x"), (1, None), (2, None), (3, "z")], "a int, b string")
    found = joins.heavy_keys_each(facts, ["a", "b"])
    assert rows(found["a"]) == [(1,)] and rows(found["b"]) == [(None,)]  # once is never heavy
    assert found["a"].dtypes == [("a", "int")]


def test_no_plan_ranks_the_keys(spark, monkeypatch):
    """Neither a sort nor a window over all keys, at any number of partitions."""
    plans = []
    real = joins.settle
    monkeypatch.setattr(joins, "settle", lambda df: plans.append(plan(df)) or real(df))
    facts = spark.range(0, 9000, 1, 4).selectExpr("if(id % 3 = 0, 1, id) as a", "id % 4 as b")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        joins.heavy_keys_each(facts.limit(0), ["a", "b"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(plans) == 2 and not any(w in p for p in plans for w in ("Sort ", "Window", "TakeOrdered", "SinglePartition"))
    found = joins.heavy_keys_each(facts, ["a", "b"])
    assert rows(found["a"]) == [(1,)] and rows(found["b"]) == [(0,), (1,), (2,), (3,)]


def test_unknown_join_type_is_refused(spark):
    with pytest.raises(ValueError):
        joins.attach(spark.range(1), spark.range(1), {"id": "id"}, how="outer")
