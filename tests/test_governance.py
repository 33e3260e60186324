import json
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from goldkeep.functions.patterns import wildcard_regex
from goldkeep.functions.tags import repeated, tags_to_map
from goldkeep.operators import governance as g
from goldkeep.operators import rules

AS_OF = datetime(2024, 2, 1)
GOOD = "Owner=a&Classification=Internal&Domain=Finance"


@pytest.fixture(scope="module")
def objects(spark):
    old, edge = AS_OF - timedelta(days=31), AS_OF - timedelta(days=30)
    return spark.createDataFrame(
        [
            ("vault/scans/page1.png", old, 10, GOOD),
            ("vault/scratch/old.bin", old, 20, GOOD),
            ("vault/scratch/edge.bin", edge, 30, GOOD),
            ("vault/journal/week7.txt", AS_OF, 40, "Owner=a&Classification=Top&Domain="),
            ("other.txt", old, 50, "A=1&A=2"),
            ("bare", old, 60, None),
        ],
        "key string, ts timestamp, size bigint, tags string",
    )


def test_retention_is_strict_and_skips_disabled_rules(objects):
    rules = [
        g.RetentionRule("r30", "vault/scratch/", 30),
        g.RetentionRule("r90", "vault/", 90),
        g.RetentionRule("off", "", 0, enabled=False),
    ]
    assert rows(g.retention_expired(objects, rules, AS_OF).select("key", "rule_id")) == [
        ("vault/scratch/old.bin", "r30")
    ]
    sooner = rules + [g.RetentionRule("r1", "vault/scratch/", 1)]
    assert rows(g.retention_expired(objects, sooner, AS_OF).select("key", "rule_id")) == [
        ("vault/scratch/edge.bin", "r1"), ("vault/scratch/old.bin", "r1")
    ]
    assert g.retention_expired(objects, [], AS_OF).count() == 0


def test_lifecycle_document():
    text = '{"Rules": [{"ID": "x", "Status": "Disabled", "Filter": {"Prefix": "t/"}, "Expiration": {"Days": 7}}]}'
    assert g.read_lifecycle(text) == [g.RetentionRule("x", "t/", 7, False)]


def test_grants(objects):
    policy = """{"Version": "2012-10-17", "Statement": [
      {"Sid": "a", "Effect": "Allow", "Principal": "*", "Action": "s3:Get*", "Resource": "arn:aws:s3:::b/vault/*"},
      {"Sid": "b", "Effect": "Allow", "Principal": "ann", "Action": "s3:GetObject", "Resource": "arn:aws:s3:::b/????"}]}"""
    grants = g.read_policy(policy)

    def allowed(action, principal="*"):
        checked = g.grant_check(objects, grants, action, "arn:aws:s3:::b/", principal)
        return sorted(r.key for r in checked.collect() if r.allowed)

    held = sorted(r.key for r in objects.collect() if r.key.startswith("vault/"))
    assert allowed("s3:GetObject") == held
    assert allowed("s3:PutObject") == []
    assert allowed("s3:GetObject", "ann") == ["bare"] + held
    with pytest.raises(ValueError):
        g.read_policy(policy.replace("Allow", "Deny"))


def read_one(**statement):
    return g.read_policy(json.dumps({"Statement": {"Sid": "s", "Effect": "Allow", **statement}}))


def test_policy_forms():
    one = {"Principal": "*", "Action": "s3:GetObject", "Resource": "arn:aws:s3:::b/*"}
    plain = g.Grant("s", "*", "s3:GetObject", "arn:aws:s3:::b/*")
    assert read_one(**one) == read_one(**one | {"Principal": {"AWS": "*"}}) == [plain]
    lists = {"Principal": {"AWS": ["ann", "bob"]}, "Action": ["s3:GetObject", "s3:PutObject"], "Resource": ["x", "y"]}
    assert len(set(read_one(**lists))) == 8
    assert g.Grant("s", "bob", "s3:PutObject", "y") in read_one(**lists)
    refused = [{"Principal": {"Service": "a"}}, {"Principal": []}, {"Action": {}}, {"Resource": [1]}, {"Condition": {}}]
    for other in refused:
        with pytest.raises(ValueError):
            read_one(**one | other)


def test_grants_of_lists(objects):
    grants = read_one(Principal={"AWS": ["ann"]}, Action=["s3:Put*", "s3:GetObject"], Resource=["r/bare", "r/other*"])
    for action, principal, keys in (
        ("s3:GetObject", "ann", {"bare", "other.txt"}), ("s3:PutObject", "ann", {"bare", "other.txt"}),
        ("s3:GetObject", "bob", set()), ("s3:DeleteObject", "ann", set()),
    ):
        checked = g.grant_check(objects, grants, action, "r/", principal).collect()
        assert {r.key for r in checked if r.allowed} == keys


def test_wildcards_match_special_characters_literally(spark):
    df = spark.createDataFrame([("a.b/c",), ("aXb/c",), ("a.b/",), ("a.b/x\ny",)], "s string")
    hit = df.where(F.col("s").rlike(wildcard_regex("a.b/*")))
    assert rows(hit) == [("a.b/",), ("a.b/c",), ("a.b/x\ny",)]


def test_tag_functions(spark):
    df = spark.createDataFrame([("A=1&B=x=y&C",), ("A=1&A=2",), ("",), (None,)], "t string")
    got = df.select(tags_to_map(F.col("t")).alias("m")).collect()
    assert got[0].m == {"A": "1", "B": "x=y", "C": None}
    assert got[1].m is None and got[2].m is None and got[3].m is None
    lists = spark.createDataFrame([(["a", "b", "a"],), (["a", "b"],), ([],)], "n array<string>")
    assert [r[0] for r in lists.select(repeated(F.col("n"))).collect()] == [["a"], [], []]


def test_tags_exploded_keep_repeats(objects):
    got = rows(g.tags_exploded(objects).where("key = 'other.txt'"))
    assert got == [("other.txt", "A", "1"), ("other.txt", "A", "2")]


def test_tag_violations(objects):
    got = rows(g.tag_violations(objects).select("key", "tag", "problem", "value"))
    missing = ["Classification", "Domain", "Owner"]
    assert got == sorted(
        [("vault/journal/week7.txt", "Classification", "not allowed", "Top"),
         ("vault/journal/week7.txt", "Domain", "missing", None),
         ("other.txt", "A", "repeated", None)]
        + [(key, tag, "missing", None) for key in ("other.txt", "bare") for tag in missing],
        key=repr,
    )


def test_prefixes(objects):
    purposes = {"vault/": "papers", "vault/scratch/": "transient", "vault/scr": "short"}
    got = {r.key: (r.prefix, r.purpose) for r in g.prefix_purpose(objects, purposes).collect()}
    assert got["vault/scratch/edge.bin"] == ("vault/scratch/", "transient")
    assert got["vault/scans/page1.png"] == ("vault/", "papers")
    assert got["bare"] == (None, None)
    assert ("vault/scratch", 2, 50) in rows(g.prefix_usage(objects))


def test_manifest(spark, objects):
    text = """
bucket_info: {name: b, created_at: "2024-01-01", region: r}
ownership: {department: d, primary_owner: o, contact_email: e}
governance: {classification: Internal, purpose: p, retention_policy: x, pii_content: false}
prefixes:
  attic/: "nothing yet"
  vault/: "papers"
"""
    manifest = g.read_manifest(text)
    row = g.manifest_row(spark, manifest)
    assert row.first().governance.pii_content is False
    assert rows(g.manifest_prefixes(row)) == [("attic/", "nothing yet"), ("vault/", "papers")]
    used = g.manifest_usage(objects, row, manifest["prefixes"])
    assert rows(used) == [("attic/", "nothing yet", 0), ("vault/", "papers", 4)]


def test_object_key(spark):
    assert spark.range(1).select(g.object_key(F.lit("vault"), F.lit("data.json"))).first()[0] == "vault/data.json"


# --- rules as tables -------------------------------------------------------------------

RULE = "rule_id string, prefix string, purpose string, days int, enabled boolean, principal string, action string, resource string"


def rule(prefix, days=1, purpose="p", enabled=True, principal="*", action="s3:Get*", resource=None, rule_id=None):
    return (rule_id or f"r{days}", prefix, purpose, days, enabled, principal, action, resource)


KEYS = ["vault/scans/1", "vault/scratch/2", "vault/", "v", "", "other", None, "vault/scans/1", "sn\\Eow/(x).[y]"]


@pytest.fixture(scope="module")
def keyed(spark):
    held = [(k, AS_OF - timedelta(days=i * 10), i) for i, k in enumerate(KEYS)]
    return spark.createDataFrame(held, "key string, ts timestamp, size int")


def test_longest_prefix_of_a_table(spark, keyed, join_path):
    given = [rule("vault/", purpose="b"), rule("vault/", purpose="a"), rule("vault/sc"), rule("", purpose="all"), rule(None)]
    got = {r.key: (r.prefix, r.purpose) for r in rules.longest_prefix(keyed, spark.createDataFrame(given, RULE)).collect()}
    assert got == {
        "vault/scans/1": ("vault/sc", "p"), "vault/scratch/2": ("vault/sc", "p"), "vault/": ("vault/", "a"), "v": ("", "all"),
        "": ("", "all"), "other": ("", "all"), KEYS[-1]: ("", "all"), None: (None, None),
    }
    none = rules.longest_prefix(keyed, spark.createDataFrame([], RULE)).collect()
    assert len(none) == len(set(KEYS)) and all(r.prefix is None for r in none)


def test_retention_by_a_table_equals_the_document(spark, keyed, join_path):
    given = [rule("vault/", 65), rule("vault/sc", 5, rule_id="z"), rule("vault/sc", 5, rule_id="a"), rule("vault/scans/", 90),
             rule("", 1, enabled=False), rule("v", 20), rule("other", 50)]
    listed = [g.RetentionRule(r[0], r[1], r[3], r[4]) for r in given]
    want = rows(g.retention_expired(keyed, listed, AS_OF))
    got = rules.retention_expired_by(keyed, spark.createDataFrame(given, RULE), AS_OF)
    assert rows(got) == want and {r.rule_id for r in got.collect()} == {"a", "r20"}
    assert rules.retention_expired_by(keyed, spark.createDataFrame([], RULE), AS_OF).count() == 0


def test_grants_of_a_table_equal_the_document(spark, keyed, join_path):
    given = [
        rule("", resource="b/vault/s*1"), rule("", resource="b/?"), rule("", resource="b/vault/scratch/*", principal="ann"),
        rule("", resource="b/vault/*", action="s3:Put*"), rule("", resource=None), rule("", resource="b/sn\\Eow/(x).[y]"),
        rule("", resource="b/vault/s?ans/*"),
    ]
    table = spark.createDataFrame(given, RULE)
    listed = [g.Grant("s", r[5], r[6], r[7]) for r in given if r[7] is not None]
    for who in ("*", "ann"):
        want = {r.key: bool(r.allowed) for r in g.grant_check(keyed, listed, "s3:GetObject", "b/", who).collect()}
        got = rules.grant_check_by(keyed, table, "s3:GetObject", "b/", who).collect()
        assert {r.key: r.allowed for r in got} == want and len(got) == len(set(KEYS))
    assert not any(r.allowed for r in rules.grant_check_by(keyed, table.limit(0), "s3:GetObject").collect())


@pytest.mark.parametrize("masks", [128, 2])
def test_grants_are_looked_up_by_all_they_fix(spark, monkeypatch, masks):
    """Patterns alike up to their first wildcard are not tried one by one."""
    monkeypatch.setattr(rules, "MASKS", masks)
    held = ["a/1\N{GRINNING FACE}7", "a/x17", "a/x1", "b/1.7", "b/\N{GRINNING FACE}17", "c", "", "a/17?", None]
    frame = spark.createDataFrame([(k,) for k in held], "key string")
    given = ["a/?17", "a/??7", "?/1*7", "b/?17*", "a/17?", "?", "*?.*", "b/??*7"]
    given = [rule("", resource=p) for p in [*given, *[f"a/?{n}" for n in range(18, 60)]]]
    listed = [g.Grant("s", r[5], r[6], r[7]) for r in given]
    want = {r.key: bool(r.allowed) for r in g.grant_check(frame, listed, "s3:GetObject").collect()}
    table = spark.createDataFrame(given, RULE)
    assert {r.key: r.allowed for r in rules.grant_check_by(frame, table, "s3:GetObject").collect()} == want
    if masks > 2:
        own, _ = rules._masked(table.select("resource"))
        assert own.agg(F.max(F.size("_patterns"))).first()[0] == 1


def test_texts_of_rules_are_not_sorted_with_the_keys(spark, keyed):
    """Rows per key are added up by hash, in tasks whose number follows the keys."""
    given = spark.createDataFrame([rule("vault/"), rule("v", purpose="q")], RULE)
    many = spark.range(rules.KEYS_PER_TASK * 9).select(F.concat(F.lit("vault/"), "id").alias("key"))
    found = rules.longest_prefix(many, given)
    assert found.rdd.getNumPartitions() > 8
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_plans_do_not_grow_with_the_rules(spark, keyed):
    def plan(n):
        many = spark.range(n).selectExpr(
            "concat('r', id) rule_id", "concat('vault/', id + 1000) prefix", "'p' purpose", "1 days", "true enabled",
            "'*' principal", "'s3:Get*' action", "concat('vault/', id + 1000, '*') resource",
        )
        found = (
            rules.longest_prefix(keyed, many), rules.retention_expired_by(keyed, many, AS_OF),
            rules.grant_check_by(keyed, many, "s3:GetObject"),
        )
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in found]
        assert not any("NestedLoop" in p or "Cartesian" in p for p in plans)
        return [p.count("\n") for p in plans]

    assert plan(10) == plan(9000)
