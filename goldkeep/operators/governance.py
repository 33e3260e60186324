"""Governance rules evaluated over an object inventory ``(key, ts, size, tags)``.

Rules, policies and manifests are short documents; they become column expressions, so an
inventory of any size is judged in one scan without a join or a shuffle.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from functools import reduce
from typing import NamedTuple

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldkeep.functions.patterns import wildcard_regex
from goldkeep.functions.tags import repeated, tag_pairs

# Default vocabulary of the governance tags; None means any value.
TAG_RULES = {
    "Classification": ["Public", "Internal", "Secret"],
    "Domain": ["Finance", "HR", "Eng"],
    "Owner": None,
}

MANIFEST_SCHEMA = (
    "bucket_info struct<name string, created_at string, region string>, "
    "ownership struct<department string, primary_owner string, contact_email string>, "
    "governance struct<classification string, purpose string, retention_policy string, "
    "pii_content boolean>, prefixes map<string, string>"
)


class RetentionRule(NamedTuple):
    """Objects under ``prefix`` expire ``days`` days after they were written."""

    rule_id: str
    prefix: str
    days: int
    enabled: bool = True


class Grant(NamedTuple):
    """One statement of a policy; ``action`` and ``resource`` may hold wildcards."""

    sid: str
    principal: str
    action: str
    resource: str


def object_key(*parts: Column | str) -> Column:
    """Object key from its path parts."""
    return F.concat_ws("/", *parts)


def _texts(value, what: str) -> list[str]:
    """A text or a list of texts as a list."""
    found = [value] if isinstance(value, str) else value
    if not isinstance(found, list) or not found or not all(isinstance(v, str) for v in found):
        raise ValueError(f"unsupported {what} in a policy: {value!r}")
    return found


def _principals(value) -> list[str]:
    """Principals of a statement: a text, a list, or either of them by ``AWS``."""
    if isinstance(value, dict):
        if set(value) != {"AWS"}:
            raise ValueError(f"unsupported principal in a policy: {value!r}")
        value = value["AWS"]
    return _texts(value, "principal")


def read_policy(text: str) -> list[Grant]:
    """Grants of a policy document, one per principal, action and resource of a statement.

    Actions, resources and principals are texts or lists of texts, and a single statement may
    stand without a list. Statements that deny, or that hold anything not evaluated here, such
    as a condition, are refused, not ignored.
    """
    statements = json.loads(text)["Statement"]
    grants = []
    for s in [statements] if isinstance(statements, dict) else statements:
        sid = s.get("Sid", "")
        unknown = set(s) - {"Sid", "Effect", "Principal", "Action", "Resource"}
        if unknown:
            raise ValueError(f"unsupported elements in statement {sid}: {sorted(unknown)}")
        if s["Effect"] != "Allow":
            raise ValueError(f"unsupported effect in statement {sid}: {s['Effect']}")
        grants += [
            Grant(sid, principal, action, resource)
            for principal in _principals(s["Principal"])
            for action in _texts(s["Action"], "action")
            for resource in _texts(s["Resource"], "resource")
        ]
    return grants


def read_lifecycle(text: str) -> list[RetentionRule]:
    """Retention rules of a lifecycle document."""
    return [
        RetentionRule(r["ID"], r["Filter"]["Prefix"], r["Expiration"]["Days"], r["Status"] == "Enabled")
        for r in json.loads(text)["Rules"]
    ]


def read_manifest(text: str) -> dict:
    """A governance manifest in YAML, of which JSON is a part."""
    return yaml.safe_load(text)


def manifest_row(spark: SparkSession, manifest: dict) -> DataFrame:
    """The manifest as one typed row."""
    return spark.createDataFrame([manifest], MANIFEST_SCHEMA)


def manifest_prefixes(manifest: DataFrame) -> DataFrame:
    """``(prefix, purpose)`` rows of a manifest."""
    return manifest.select(F.explode("prefixes").alias("prefix", "purpose"))


def retention_expired(
    objects: DataFrame, rules: list[RetentionRule], as_of: datetime
) -> DataFrame:
    """Objects past their retention, with the rule that expired them first."""
    ts_type = objects.schema["ts"].dataType
    enabled = sorted((r for r in rules if r.enabled), key=lambda r: (r.days, r.rule_id))

    def cutoff(rule: RetentionRule) -> Column:
        return F.lit((as_of - timedelta(days=rule.days)).isoformat(sep=" ")).cast(ts_type)

    def hit(rule: RetentionRule) -> Column:
        return F.col("key").startswith(rule.prefix) & (F.col("ts") < cutoff(rule))

    if enabled:  # what no rule can expire is left out by the scan
        objects = objects.where(F.col("ts") < cutoff(enabled[0]))
    expired = reduce(lambda a, b: a | b, [hit(r) for r in enabled], F.lit(False))
    rule_id = F.coalesce(F.lit(None).cast("string"), *[F.when(hit(r), r.rule_id) for r in enabled])
    return objects.where(expired).withColumn("rule_id", rule_id)


def grant_check(
    objects: DataFrame,
    grants: list[Grant],
    action: str,
    resource_root: str = "",
    principal: str = "*",
) -> DataFrame:
    """``(key, allowed)``: whether a grant lets ``principal`` do ``action`` on the object."""
    resource = F.concat(F.lit(resource_root), "key")
    allowed = F.lit(False)
    for grant in grants:
        if grant.principal in ("*", principal):
            may = F.lit(action).rlike(wildcard_regex(grant.action))
            allowed = allowed | (may & resource.rlike(wildcard_regex(grant.resource)))
    return objects.select("key", allowed.alias("allowed"))


def tags_exploded(objects: DataFrame) -> DataFrame:
    """``(key, tag, value)``, one row per written tag."""
    return objects.select("key", F.inline(tag_pairs(F.col("tags"))))


def tag_violations(
    objects: DataFrame, rules: dict[str, list[str] | None] = TAG_RULES
) -> DataFrame:
    """``(key, tag, value, problem)`` for missing, repeated and not allowed tags."""
    none = F.array().cast("array<struct<tag:string,value:string>>")
    parsed = objects.select("key", F.coalesce(tag_pairs(F.col("tags")), none).alias("_pairs"))
    pairs = F.col("_pairs")

    def problem(tag: Column, value: Column, text: str) -> Column:
        return F.struct(
            tag.alias("tag"), value.cast("string").alias("value"), F.lit(text).alias("problem")
        )

    def check(tag: str, allowed: list[str] | None) -> list[Column]:
        def written(p: Column) -> Column:
            return (p["tag"] == tag) & (F.length(p["value"]) > 0)

        missing = problem(F.lit(tag), F.lit(None), "missing")
        found = [F.when(~F.exists(pairs, written), F.array(missing))]
        if allowed is not None:
            wrong = F.filter(pairs, lambda p: written(p) & ~p["value"].isin(*allowed))
            found.append(
                F.transform(wrong, lambda p: problem(p["tag"], p["value"], "not allowed"))
            )
        return found

    found = [c for tag, allowed in rules.items() for c in check(tag, allowed)]
    names = F.transform(pairs, lambda p: p["tag"])
    found.append(F.transform(repeated(names), lambda t: problem(t, F.lit(None), "repeated")))
    groups = parsed.select("key", F.flatten(F.array_compact(F.array(*found))).alias("_problems"))
    # the outer form spares an inferred filter that would repeat all of the above
    rows = groups.select("key", F.inline_outer("_problems"))
    return rows.where(F.col("problem").isNotNull())


def prefix_purpose(objects: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """``(key, prefix, purpose)`` by the longest manifest prefix; null where none matches."""
    longest_first = sorted(prefixes, key=lambda p: (-len(p), p))
    prefix = F.coalesce(
        F.lit(None).cast("string"),
        *[F.when(F.col("key").startswith(p), F.lit(p)) for p in longest_first],
    )
    purpose = F.coalesce(
        F.lit(None).cast("string"),
        *[F.when(F.col("prefix") == p, F.lit(prefixes[p])) for p in longest_first],
    )
    return objects.select("key", prefix.alias("prefix")).withColumn("purpose", purpose)


def prefix_usage(objects: DataFrame, depth: int = 2) -> DataFrame:
    """Objects and bytes per leading ``depth`` path parts."""
    return objects.groupBy(F.substring_index("key", "/", depth).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n_objects"), F.sum("size").alias("n_bytes")
    )


def manifest_usage(objects: DataFrame, manifest: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """Each manifest prefix with its purpose and the objects it governs, unused ones too."""
    used = prefix_purpose(objects, prefixes).groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    return manifest_prefixes(manifest).join(used, "prefix", "left").select(
        "prefix", "purpose", F.coalesce("n", F.lit(0)).alias("n_objects")
    )
