import random

import pytest
from conftest import rows

from goldkeep.operators import constraints, integrity, keyfilter


@pytest.fixture(params=["filter", "no filter"])
def either(request, monkeypatch):
    if request.param == "no filter":
        monkeypatch.setattr(keyfilter, "FILTER_BYTES", 7)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_filtered_checks_equal_the_plain_ones(spark, either, kind):
    rng = random.Random(5)
    of = (lambda n: n) if kind == "long" else (lambda n: f"key {n}")
    facts = [(of(rng.randrange(400)),) for _ in range(900)] + [(None,)]
    master = [(of(n),) for n in range(0, 300, 2)] + [(None,)]
    f, m = spark.createDataFrame(facts, f"id {kind}"), spark.createDataFrame(master, f"id {kind}")
    assert rows(keyfilter.orphans(f.distinct(), m)) == rows(integrity.orphans(f.distinct(), m))
    assert rows(keyfilter.unused(f, m)) == rows(integrity.unused(f.distinct(), m))
    want = constraints.fk_violations(f, "id", m, "id")
    assert rows(keyfilter.fk_violations(f, "id", m, "id")) == rows(want)


def test_empty_sides_and_other_key_types(spark, either):
    few = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(keyfilter.orphans(few, few.limit(0))) == [(1,), (2,)]
    assert rows(keyfilter.orphans(few.limit(0), few)) == []
    assert rows(keyfilter.unused(few.limit(0), few)) == [(1,), (2,)]
    wide = few.selectExpr("cast(id as long) as id")
    assert rows(keyfilter.orphans(few, wide)) == [] == rows(keyfilter.unused(wide, few))


def test_few_absent_keys_reach_the_join(spark):
    master, facts = spark.range(0, 5000), spark.range(4000, 24000)
    known = keyfilter.key_filter(master)
    assert facts.where("id < 5000").where(~known.may_hold(facts["id"])).count() == 0
    passed = facts.where("id >= 5000").where(known.may_hold(facts["id"])).count()
    assert passed < 0.03 * 19000
    plan = keyfilter.orphans(facts, master)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
