"""Governance rules that are tables themselves: thousands of prefixes, retention rules or grants.

A rule is found by equality, never by trying rules one by one. Which lengths the prefixes of
the rules have is read from the rules; every key is cut to each of those lengths once, and the
cuts are looked up (:func:`~goldkeep.operators.joins.attach`: a broadcast within its bound, else a
shuffle that spreads frequent cuts). Plans grow with the number of lengths, which keys bound,
and not with the number of rules.

A key is judged once however often it occurs. A null key fits no rule, an empty prefix every key.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeep.functions.patterns import literal_head, wildcard_column
from goldkeep.operators.joins import attach
from goldkeep.operators.ranking import dense_index
from goldkeep.shared import settle

#: Distinct keys that one task cuts and judges.
KEYS_PER_TASK = 100_000
#: Masks of patterns that every key is cut by.
MASKS = 128


def matching(keys: DataFrame, rules: DataFrame, key: str, prefix: str) -> DataFrame:
    """``keys`` (one column) with every row of ``rules`` whose ``prefix`` they begin with.
    Prefixes must be unique; ``rules`` should be settled."""
    lengths = [r[0] for r in rules.select(F.length(prefix)).distinct().collect() if r[0] is not None]
    if not lengths:
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rules.schema.fields]
        return keys.limit(0).select(key, *none)
    cuts = [F.when(F.length(key) >= n, F.substring(key, 1, n)) for n in sorted(lengths)]
    tried = keys.select(key, F.explode(F.array_compact(F.array(*cuts))).alias("_cut"))
    named = rules.withColumn("_prefix", F.col(prefix))
    return attach(tried, named, {"_cut": "_prefix"}, how="inner").drop("_cut")


def _dealt(keys: DataFrame) -> DataFrame:
    """``keys`` (one column, distinct), settled and dealt so that a task has ``KEYS_PER_TASK`` at
    most: their cuts are many times their bytes, by which partitions would be put together."""
    held = settle(keys)
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return held.repartition(max(tasks, -(-held.count() // KEYS_PER_TASK)), *keys.columns)


def longest_prefix(
    objects: DataFrame, rules: DataFrame, prefix: str = "prefix", value: str = "purpose"
) -> DataFrame:
    """``key``, ``prefix`` and ``value`` of the longest rule each key begins with, null where none
    does. Of rules with one prefix the smallest value counts."""
    own = settle(rules.groupBy(prefix).agg(F.min(value).alias(value)).where(F.col(prefix).isNotNull()))
    keys = _dealt(objects.select("key").distinct())
    found = matching(keys, own.select(prefix), "key", prefix)
    # a key that no rule fits has a row without a length alone; numbers are added up by hash, so
    # no task sorts the rows, and texts come to the one rule that is left
    lengths = found.select("key", F.length(prefix).alias("_n"))
    rows = lengths.unionByName(keys.select("key", F.lit(None).cast("int").alias("_n")))
    best = settle(rows.groupBy("key").agg(F.max("_n").alias("_n")))
    named = best.select("key", F.substring("key", F.lit(1), F.col("_n")).alias("_best"))
    named = attach(named, own.select(prefix, F.col(prefix).alias("_own"), value), {"_best": prefix})
    return named.select("key", F.col("_own").alias(prefix), value)


def retention_expired_by(objects: DataFrame, rules: DataFrame, as_of: datetime) -> DataFrame:
    """Objects past their retention with the ``rule_id`` that expired them first.

    ``rules`` has ``rule_id``, ``prefix``, ``days`` and ``enabled``. Of the rules for a key the one
    with the fewest days decides, so a key is looked up once, whatever the age of its objects.
    """
    first = F.min(F.struct("days", "rule_id"))
    own = settle(
        rules.where("enabled and prefix is not null and days is not null")
        .groupBy("prefix")
        .agg(first.alias("rule"))
    )
    least = own.agg(F.min("rule.days")).first()[0]
    ts = objects.schema["ts"].dataType

    def cutoff(days: Column) -> Column:
        passed = F.make_dt_interval(days)
        return (F.lit(as_of.isoformat(sep=" ")).cast(ts) - passed).cast(ts)

    if least is None:
        return objects.limit(0).withColumn("rule_id", F.lit(None).cast("string"))
    old = objects.where(F.col("ts") < cutoff(F.lit(least)))  # no rule can expire the others
    # a rule goes by its place among all rules: numbers are compared by hash, without a sort
    placed = dense_index(own.select(F.struct("rule", "prefix").alias("at")), "at", "_place")
    placed = settle(placed.select("at.prefix", "at.rule", "_place"))
    found = matching(_dealt(old.select("key").distinct()), placed.select("prefix", "_place"), "key", "prefix")
    first = settle(found.groupBy("key").agg(F.min("_place").alias("_first")))
    rule = placed.select("_place", F.col("rule").alias("_rule"))
    decided = settle(attach(first, rule, {"_first": "_place"}, how="inner").select("key", "_rule"))
    judged = attach(old, decided, {"key": "key"}, how="inner")
    expired = judged.where(F.col("ts") < cutoff(F.col("_rule.days").cast("int")))
    return expired.select(*objects.columns, F.col("_rule.rule_id").alias("rule_id"))


def _masked(resources: DataFrame) -> tuple[DataFrame, list[str]]:
    """Patterns by what they fix: ``_text``, the mask and the characters that it fixes, whether a key
    that has them fits at once (``_all``), and the patterns to verify otherwise.

    The mask of a pattern is the part before its first ``*`` with every character written ``x``, and
    that ``*``. Of the masks the ``MASKS`` most frequent ones are used as they are; a pattern of another
    goes by the text before its first wildcard and is always verified.
    """
    start = F.regexp_extract("resource", "^[^*]*", 0)
    open_ = F.contains("resource", F.lit("*"))
    mask = F.concat(F.regexp_replace(start, "(?s)[^?]", "x"), F.when(open_, F.lit("*")).otherwise(F.lit("")))
    sure = ~open_ | (F.col("resource") == F.concat(start, F.lit("*")))
    named = settle(
        resources.where("resource is not null").select("resource", mask.alias("_mask"), sure.alias("_sure")).distinct()
    )
    common = named.groupBy("_mask").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "_mask").limit(MASKS)
    kept = [r[0] for r in common.collect()]
    head = literal_head(F.col("resource"))
    used = F.col("_mask").isin(*kept) if kept else F.lit(False)
    text = F.when(used, F.replace(start, F.lit("?"), F.lit(""))).otherwise(head)
    mask = F.when(used, F.col("_mask")).otherwise(F.concat(F.regexp_replace(head, "(?s).", "x"), F.lit("*")))
    known = named.select("resource", (used & F.col("_sure")).alias("_sure"), mask.alias("_mask"), text.alias("_own"))
    patterns = F.array_compact(F.collect_set(F.when(~F.col("_sure"), wildcard_column(F.col("resource")))))
    own = settle(
        known.groupBy(F.concat("_mask", F.lit(":"), "_own").alias("_text"), "_mask")
        .agg(F.max("_sure").alias("_all"), patterns.alias("_patterns"))
    )
    masks = [r[0] for r in own.select("_mask").distinct().collect()]
    return own.drop("_mask"), sorted(masks)


def _fixed(key: str, mask: str) -> Column:
    """The mask and the characters that it fixes, null for a key that is too short or too long."""
    length = len(mask.removesuffix("*"))
    pieces = [F.substring(key, m.start() + 1, m.end() - m.start()) for m in re.finditer("x+", mask)]
    fits = F.length(key) >= length if mask.endswith("*") else F.length(key) == length
    return F.when(fits, F.concat(F.lit(mask + ":"), *pieces))


def grant_check_by(
    objects: DataFrame,
    grants: DataFrame,
    action: str,
    resource_root: str = "",
    principal: str = "*",
) -> DataFrame:
    """``(key, allowed)``: whether a grant lets ``principal`` do ``action`` on the object.

    ``grants`` has ``principal``, ``action`` and ``resource`` with wildcards. A resource is looked up by
    the characters that it fixes before its first ``*``, those behind a ``?`` included; what follows
    is verified by the whole pattern, unless nothing or a final ``*`` does.
    """
    asked = grants.where(F.col("principal").isin("*", principal))
    asked = asked.where(F.rlike(F.lit(action), wildcard_column(F.col("action"))))
    own, masks = _masked(asked)
    keys = _dealt(objects.select(F.concat(F.lit(resource_root), "key").alias("_resource")).distinct())
    cuts = F.array(*[_fixed("_resource", m) for m in masks]) if masks else F.array().cast("array<string>")
    tried = keys.select("_resource", F.explode(F.array_compact(cuts)).alias("_cut"))
    found = attach(tried, own, {"_cut": "_text"}, how="inner")
    fits = F.col("_all") | F.exists("_patterns", lambda p: F.rlike(F.col("_resource"), p))
    hits = found.select("_resource", fits.alias("_hit"))
    every = hits.unionByName(keys.select("_resource", F.lit(False).alias("_hit")))
    decided = every.groupBy("_resource").agg(F.bool_or("_hit").alias("allowed"))
    cut = F.substring("_resource", len(resource_root) + 1, 1 << 30)
    return decided.select(cut.alias("key"), F.coalesce("allowed", F.lit(False)).alias("allowed"))
