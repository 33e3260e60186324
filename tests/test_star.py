import os
import uuid

import pytest
from conftest import rows

from goldkeep.operators.dedup import golden_records
from goldkeep.operators.star import Dimension, build_dimension, build_star
from goldkeep.plans.cleanse import cleanse
from goldkeep.plans.reconcile import reconcile
from goldkeep.plans.star_load import load_star
from goldkeep.sources import publish

DISTRICT = Dimension("dim_district", "district", "DistrictID", "DistrictName")
TIER = Dimension("dim_tier", "tier", "TierID", "TierName")
MATCH = ["stop", "district"]


@pytest.fixture(scope="module")
def golden(stops):
    return golden_records(stops, MATCH, "stop_id")


def test_dimensions_follow_first_appearance(golden):
    boroughs = build_dimension(golden, "stop_id", DISTRICT)
    assert boroughs.columns == ["DistrictID", "DistrictName"]
    assert rows(boroughs) == [
        (0, "Harbour"), (1, "Hillside"), (2, "Old Town"), (3, "Unmapped"), (4, None)
    ]
    services = build_dimension(golden, "stop_id", TIER)
    assert rows(services) == [(0, "coast"), (1, "valley"), (2, "ring"), (3, None)]


def test_star_keeps_rows_with_missing_members(golden, join_path):
    star = build_star(golden, "stop_id", ["stop"], [DISTRICT, TIER], "dim_stops")
    table = star["dim_stops"]
    assert table.columns == ["stop_id", "stop", "DistrictID", "TierID"]
    got = {r.stop_id: (r.DistrictID, r.TierID) for r in table.collect()}
    assert len(got) == golden.count()
    assert got[70] == (3, 3) and got[71] == (4, 3) and got[30] == (2, 2)


@pytest.fixture(params=["files", "tables"])
def store(request, tmp_path):
    if request.param == "files":
        return publish.ParquetStore(str(tmp_path / "star"))
    return publish.CatalogStore(prefix=f"t{uuid.uuid4().hex[:8]}_")


def test_publish_when_all_keys_hold(spark, golden, store):
    with pytest.raises(LookupError):
        publish.published(spark, store, "dim_stops")
    for _ in range(3):  # replacing works over an earlier publication
        load_star(spark, golden, "stop_id", ["stop"], [DISTRICT, TIER], "dim_stops", store)
    assert publish.published(spark, store, "dim_stops").count() == golden.count()
    assert publish.published(spark, store, "dim_district").count() == 5
    if isinstance(store, publish.CatalogStore):
        assert spark.table(f"{store.start}dim_tier").count() == 4


def test_superseded_versions_are_removed(spark, golden, tmp_path):
    store = publish.ParquetStore(str(tmp_path))
    for _ in range(4):
        load_star(spark, golden, "stop_id", ["stop"], [DISTRICT], "dim_stops", store)
    assert len(os.listdir(tmp_path)) == 3  # the list, the latest version and the one before


PARENT, CHILD = "pid int, name string", "id int, pid int"
KEYS = [publish.PrimaryKey("parent", ["pid"]), publish.PrimaryKey("child", ["id"])]
LINK = [publish.ForeignKey("child", "pid", "parent", "pid")]


def family(spark, parent, child):
    return {
        "parent": spark.createDataFrame(parent, PARENT),
        "child": spark.createDataFrame(child, CHILD),
    }


def state(spark, store):
    return [rows(publish.published(spark, store, n)) for n in ("parent", "child")]


@pytest.mark.parametrize("step", ["child", "list"])
def test_a_stopped_publication_changes_nothing(spark, store, monkeypatch, step):
    publish.publish(spark, family(spark, [(0, "a"), (1, "b")], [(1, 0), (2, 1)]), store, KEYS, LINK)
    before = state(spark, store)
    kind, write = type(store), type(store).write

    def stop(*_):
        raise KeyboardInterrupt

    if step == "child":
        monkeypatch.setattr(
            kind, "write", lambda self, v, name, df: stop() if name == "child" else write(self, v, name, df)
        )
    else:
        monkeypatch.setattr(kind, "add", stop)
    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, family(spark, [(0, "b")], [(2, 0)]), store, KEYS, LINK)
    assert state(spark, store) == before
    monkeypatch.undo()
    publish.publish(spark, family(spark, [(0, "b")], [(2, 0)]), store, KEYS, LINK)
    assert state(spark, store) == [[(0, "b")], [(2, 0)]]


def test_two_publishers_at_once(spark, store, monkeypatch):
    """A second publisher comes in between the first one's look at the list and its entry."""
    publish.publish(spark, family(spark, [(9, "z")], [(9, 9)]), store, KEYS, LINK)
    kind, add, other = type(store), type(store).add, []

    def late(self, session, entry):
        if not other:
            other.append(entry.number)
            publish.publish(spark, family(spark, [(0, "second")], [(1, 0)]), store, KEYS, LINK)
            assert state(spark, store) == [[(0, "second")], [(1, 0)]]
        return add(self, session, entry)

    monkeypatch.setattr(kind, "add", late)
    publish.publish(spark, family(spark, [(5, "first")], [(2, 5)]), store, KEYS, LINK)
    assert state(spark, store) == [[(5, "first")], [(2, 5)]]
    listed = store.publications(spark)
    assert [p.number for p in listed] == [other[0], other[0] + 1]  # neither is lost
    assert rows(store.read(spark, listed[0].version, "parent")) == [(0, "second")]
    if isinstance(store, publish.CatalogStore):
        assert rows(spark.table(store.start + "parent")) == [(5, "first")]


def test_an_unfinished_entry_is_no_publication(spark, tmp_path):
    store = publish.ParquetStore(str(tmp_path))
    publish.publish(spark, family(spark, [(0, "a")], [(1, 0)]), store, KEYS, LINK)
    (tmp_path / "list" / f"{1:012d}.json").write_text('{"version": ')
    assert state(spark, store) == [[(0, "a")], [(1, 0)]]
    publish.publish(spark, family(spark, [(3, "b")], [(4, 3)]), store, KEYS, LINK)
    assert state(spark, store) == [[(3, "b")], [(4, 3)]] and store.publications(spark)[-1].number == 2


def test_nothing_is_published_on_a_violation(spark, store):
    good = family(spark, [(0, "a")], [(1, 0)])
    publish.publish(spark, good, store, KEYS, LINK)
    before = state(spark, store)
    with pytest.raises(publish.ConstraintError) as failure:
        bad = family(spark, [(0, "a"), (0, "b")], [(1, 0), (2, 5), (3, None)])
        publish.publish(spark, bad, store, KEYS, LINK)
    assert failure.value.problems == {"primary key parent": 1, "foreign key child.pid": 1}
    assert state(spark, store) == before


def test_cleanse(stops):
    done = cleanse(stops, MATCH, "stop_id", "stop")
    assert done.golden.count() == 9
    assert [r.stop_id for r in done.duplicates.collect()] == [8, 9, 20, 21, 22]
    assert rows(done.counts) == [(12, 9, 3, 5)]
    assert [(r.name_a, r.name_b) for r in done.similar.collect()] == [("Lantern Street East", "Lantern Street West")]


def test_reconcile_leaves_only_true_orphans(spark, stops):
    trips = spark.createDataFrame(
        [(9, 21, 1), (22, 3, 2), (5, 9, 3), (None, 999, 4)], "pu long, do long, n int"
    )
    done = reconcile(trips, ["pu", "do"], stops, MATCH, "stop_id")
    assert rows(done.facts) == [(20, 3, 2), (5, 8, 3), (8, 20, 1), (None, 999, 4)]
    assert rows(done.report.orphans) == [(999,), (None,)]
    assert rows(done.report.summary) == [("ALERT", 2, 6, 9, 5)]
