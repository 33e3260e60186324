import random
import re

import pytest
from conftest import rows

from goldkeep.operators import constraints, keycounts
from goldkeep.operators.integrity import integrity_report, keys
from goldkeep.plans.reconcile import check_stored, reconcile
from goldkeep.shared import scratch_table


def store(spark, *columns, buckets=4):
    return keycounts.KeyCounts(spark, scratch_table("counts"), columns, buckets)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def batches(spark):
    rng = random.Random(3)
    made = []
    for n in (300, 200, 0, 150):
        lines = [(rng.choice([None, *range(90)]), rng.choice("abc"), "other") for _ in range(n)]
        made.append(spark.createDataFrame([(7, "a", "hot")] * n + lines, "id long, kind string, n_rows string"))
    return made


def test_counts_over_batches_equal_the_check_over_all_rows(spark, batches):
    stored = store(spark, "id", "kind")
    every = batches[0]
    for number, batch in enumerate(batches):
        stored.load(str(number), batch)
        every = every.union(batch) if number else every
        assert rows(stored.pk_violations()) == rows(constraints.pk_violations(every, ["id", "kind"]))
    merged = stored.merged_into(scratch_table("counts"), "all")
    assert rows(merged.counts()) == rows(stored.counts())


def test_foreign_keys_over_batches(spark, batches):
    stored, parents = store(spark, "id"), spark.range(10, 60).toDF("parent")
    stored.load("first", batches[0])
    stored.load("second", batches[1])
    want = constraints.fk_violations(batches[0].union(batches[1]), "id", parents, "parent")
    assert rows(stored.fk_violations(parents, "parent")) == rows(want)


def test_a_batch_that_comes_again_replaces_itself_alone(spark, batches):
    stored = store(spark, "id")
    stored.load("first", batches[0])
    alone = rows(stored.counts())
    stored.load("second", batches[1])
    both = rows(stored.counts())
    stored.load("second", batches[1])
    assert rows(stored.counts()) == both != alone
    stored.load("second", batches[2])  # is empty now
    assert rows(stored.counts()) == alone
    stored.load("first", batches[2])
    assert rows(stored.counts()) == []


@pytest.fixture
def joins_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_checks_do_not_move_the_stored_counts(spark, batches, joins_shuffle):
    stored = store(spark, "id", buckets=16)
    for number, batch in enumerate(batches):
        stored.load(str(number), batch)
    assert "Exchange" not in plan(stored.pk_violations())
    counts, parents = plan(stored.fk_violations(spark.range(10).toDF("parent"), "parent")).split("FileScan")
    assert "Exchange" not in counts
    assert re.findall(r"Exchange hashpartitioning\(id#\d+L, (\d+)\)", parents) == ["16"]


def test_stored_reports_equal_those_of_the_facts(spark, stops):
    facts = spark.createDataFrame([(n % 47,) for n in range(300)] + [(None,), (8,)], "stop long")
    stored = store(spark, "stop")
    stored.load("odd", facts.where("stop % 2 = 1 or stop is null"))
    stored.load("even", facts.where("stop % 2 = 0"))
    match = ["stop", "district"]
    done = check_stored(stored, stops, match, "stop_id")
    want = reconcile(facts, ["stop"], stops, match, "stop_id")
    for got, kept in zip(done.after, want.report):
        assert rows(got) == rows(kept)
    golden = stops.groupBy(*match).agg({"stop_id": "min"}).select("min(stop_id)").toDF("id")
    for got, kept in zip(done.before, integrity_report(keys(facts, "stop"), golden)):
        assert rows(got) == rows(kept)
    assert rows(done.crosswalk) == rows(want.crosswalk)
