import pytest
from conftest import rows

from goldkeep.operators import constraints, integrity, remap


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def test_null_fact_key_is_an_orphan(spark):
    facts = integrity.key_set(ids(spark, 1, None, None), "id")
    for master in (ids(spark, 1), ids(spark, 1, None)):
        assert rows(integrity.orphans(facts, master)) == [(None,)]
    assert rows(integrity.integrity_summary(facts, ids(spark, 1))) == [("ALERT", 1, 2, 1, 0)]


def test_report_counts_both_directions(spark):
    report = integrity.integrity_report(ids(spark, 1, 2, 9), ids(spark, 1, 2, 3, 4))
    assert rows(report.summary) == [("ALERT", 1, 3, 4, 2)]
    assert rows(report.orphans) == [(9,)]
    assert rows(report.unused) == [(3,), (4,)]
    assert rows(integrity.integrity_summary(ids(spark, 1), ids(spark, 1, 2))) == [("SUCCESS", 0, 1, 2, 1)]
    assert rows(integrity.integrity_summary(ids(spark), ids(spark))) == [("SUCCESS", 0, 0, 0, 0)]


def test_two_roles_in_one_scan(spark):
    trips = spark.createDataFrame([(1, 2), (2, 2), (None, 5)], "pu long, do long")
    both = integrity.key_set(trips, "pu", "do")
    assert rows(both) == [(1,), (2,), (5,), (None,)]
    apart = integrity.union_keys(integrity.key_set(trips, "pu"), integrity.key_set(trips, "do"))
    assert rows(apart) == rows(both)


def test_remap_does_not_chain(spark):
    df = ids(spark, 1, 2, 3)
    assert rows(remap.remap_literal(df, {1: 2, 2: 3}, ["id"])) == [(2,), (3,), (3,)]
    walk = spark.createDataFrame([(1, 2), (2, 3)], "retired_id long, golden_id long")
    with pytest.raises(ValueError, match="target is itself retired"):
        remap.remap_keys(df, walk, ["id"])
    twice = spark.createDataFrame([(1, 2), (1, 3)], "retired_id long, golden_id long")
    with pytest.raises(ValueError, match="retired twice"):
        remap.remap_keys(df, twice, ["id"])


def test_remap_two_columns(spark, join_path):
    trips = spark.createDataFrame(
        [(9, 1, "a"), (21, 22, "b"), (None, 9, "c"), (2, 2, "d")] + [(9, 9, "e")] * 50,
        "pu long, do long, note string",
    )
    walk = spark.createDataFrame([(9, 8), (21, 20), (22, 20)], "retired_id long, golden_id long")
    done = remap.remap_keys(trips, walk, ["pu", "do"])
    assert done.columns == trips.columns
    assert rows(done) == sorted(
        [(8, 1, "a"), (20, 20, "b"), (None, 8, "c"), (2, 2, "d")] + [(8, 8, "e")] * 50, key=repr
    )
    assert rows(remap.remap_literal(trips, {9: 8, 21: 20, 22: 20}, ["pu", "do"])) == rows(done)


def test_primary_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    assert rows(constraints.pk_violations(df, ["a", "b"])) == [(1, 1, 2), (None, 3, 1)]


def test_foreign_keys_skip_nulls(spark):
    child = spark.createDataFrame([(1,), (7,), (7,), (None,)], "k long")
    assert rows(constraints.fk_violations(child, "k", ids(spark, 1, 2), "id")) == [(7, 2)]
