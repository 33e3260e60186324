import random

import pytest
from conftest import rows

from goldkeep.operators import dedup
from goldkeep.operators.ranking import dense_index, distinct_ordered, members

MATCH = ["stop", "district"]


def test_exact_duplicates_marks_all_copies(stops, join_path):
    copies = dedup.exact_duplicates(stops, MATCH, "stop_id")
    assert copies.columns == stops.columns
    assert sorted(r.stop_id for r in copies.collect()) == [8, 9, 20, 21, 22]


def test_golden_records_keep_the_first(stops):
    kept = dedup.golden_records(stops, MATCH, "stop_id")
    assert kept.columns == stops.columns
    assert sorted(r.stop_id for r in kept.collect()) == [3, 5, 8, 20, 30, 31, 44, 70, 71]
    ids = dedup.golden_ids(stops, MATCH, "stop_id")
    assert rows(ids) == rows(kept.select("stop_id"))


def test_crosswalk(stops, join_path):
    assert rows(dedup.crosswalk(stops, MATCH, "stop_id")) == [(21, 20), (22, 20), (9, 8)]


def test_counts(stops):
    assert rows(dedup.dedup_counts(stops, MATCH)) == [(12, 9, 3, 5)]
    assert rows(dedup.dedup_counts(stops.where("false"), MATCH)) == [(0, 0, 0, 0)]


def test_nulls_are_equal(spark, join_path):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "x"), (3, None, None)], "id int, a string, b string")
    assert rows(dedup.golden_records(df, ["a", "b"], "id").select("id")) == [(1,), (3,)]
    assert rows(dedup.exact_duplicates(df, ["a", "b"], "id").select("id")) == [(1,), (2,)]
    assert rows(dedup.crosswalk(df, ["a", "b"], "id")) == [(2, 1)]


def test_sort_puts_nulls_last(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "a")], "id int, s string")
    assert [r.id for r in dedup.sorted_by(df, "s", "id").collect()] == [3, 4, 1, 2]


def test_one_group_holds_a_third_of_the_rows(spark, join_path):
    rng = random.Random(1)
    data = [(i, "hot" if i % 3 == 0 else str(rng.randrange(400))) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, k string").repartition(8)
    first, size = {}, {}
    for i, k in data:
        first.setdefault(k, i)
        size[k] = size.get(k, 0) + 1
    assert rows(dedup.crosswalk(df, ["k"], "id")) == sorted(
        ((i, first[k]) for i, k in data if i != first[k]), key=repr
    )
    assert rows(dedup.exact_duplicates(df, ["k"], "id")) == sorted(
        ((i, k) for i, k in data if size[k] > 1), key=repr
    )


def test_retired_and_golden_add_up(stops):
    retired = dedup.crosswalk(stops, MATCH, "stop_id")
    golden = dedup.golden_ids(stops, MATCH, "stop_id")
    assert retired.count() + golden.count() == stops.count()
    targets = retired.selectExpr("golden_id as stop_id")
    assert targets.join(golden, "stop_id", "left_anti").isEmpty()


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_dense_index_is_gapless(spark, n):
    df = spark.range(n).selectExpr("id * 7 - 3 as first", "cast(id as string) as v").repartition(7)
    got = {r.first: r.nr for r in dense_index(df, "first", "nr").collect()}
    assert got == {i * 7 - 3: i for i in range(n)}


def test_dense_index_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1000).selectExpr("(id * 37) % 1000 as first")
        got = sorted((r.first, r.nr) for r in dense_index(df, "first", "nr").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == [(i, i) for i in range(1000)]


def test_distinct_ordered_drops_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (4, None), (5, "x")], "id int, s string")
    assert rows(distinct_ordered(df, "s", "id")) == [("x", 0), ("y", 1)]
    assert rows(members(df, "s", "id", "s", "nr")) == [("x", 0), ("y", 2), (None, 1)]
