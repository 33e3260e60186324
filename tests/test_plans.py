"""The physical plans are the ones the operators promise."""

import re

import pytest
from conftest import SMALL

from goldkeep.operators import integrity
from workload.queries import QUERIES


def plan(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_golden_records_shuffle_only_group_winners(spark):
    text = plan(spark, "golden_records")
    partial = text.index("row_number(), 1, Partial")
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < partial


@pytest.mark.parametrize("name", ["remap_keys", "remap_two_roles", "remap_literal", "star_dim"])
def test_rows_are_not_shuffled(spark, name):
    assert "Exchange hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize(
    "name",
    ["object_inventory", "retention_expired", "grant_check", "tags_to_map", "tags_exploded",
     "tag_violations", "prefix_purpose", "normalise_missing", "json_fields", "key_projection"],
)
def test_rules_need_one_scan_and_no_shuffle(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text and "Join" not in text and text.count("FileScan") == 1


@pytest.mark.parametrize(
    "name, columns",
    [("orphans", ["l_partkey"]), ("fk_violations", ["l_partkey"]), ("pk_violations", ["l_orderkey", "l_linenumber"]),
     ("integrity_before_remap", ["l_partkey"]), ("integrity_after_remap", ["l_partkey"]),
     ("two_role_keys_one_table", ["l_partkey", "l_suppkey"])],
)
def test_fact_scans_read_only_their_keys(spark, monkeypatch, name, columns):
    monkeypatch.setattr(integrity, "settle", lambda df: df)  # keep the facts in the plan
    schemas = re.findall(r"ReadSchema: struct<(l_[^>]*)>", plan(spark, name))
    assert schemas and all([c.split(":")[0] for c in s.split(",")] == columns for s in schemas)


def test_filters_reach_the_scan(spark):
    assert "LessThan(ts" in plan(spark, "retention_expired").split("PushedFilters:")[1]


def test_summary_shuffles_facts_once(spark):
    text = plan(spark, "integrity_before_remap")
    assert len(re.findall(r"Exchange hashpartitioning\(id", text)) == 1


def test_only_the_name_scoring_runs_in_python(spark):
    for name in QUERIES:
        if not name.startswith("fuzzy"):
            assert "Python" not in plan(spark, name)
    assert plan(spark, "fuzzy_pairs").count("ArrowEvalPython") == 1


@pytest.mark.parametrize("name", ["fuzzy_pairs", "fuzzy_urls"])
def test_key_rows_are_never_broadcast(spark, name):
    text = plan(spark, name)
    assert "SortMergeJoin [short_len" in text and "BroadcastHashJoin [short_len" not in text
