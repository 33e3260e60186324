"""Every operator over whole test tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldkeep.functions.missing import normalise_missing
from goldkeep.functions.tags import tags_to_map
from goldkeep.operators import constraints, dedup, governance, integrity, keycounts, keyfilter, profile, ranking
from goldkeep.operators import remap
from goldkeep.operators import rules as rule_tables
from goldkeep.operators import similarity, star
from goldkeep.plans import reconcile, star_load
from goldkeep.shared import scratch_path, scratch_table, settle
from goldkeep.sources import files, layout, publish
from workload.tables import (
    AS_OF,
    LIFECYCLE,
    MANIFEST,
    MATCH,
    POLICY,
    RESOURCE_ROOT,
    objects,
    parts,
    rules,
    table,
)

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
BRAND = star.Dimension("dim_borough", "p_brand", "BrandID", "BrandName")
KIND = star.Dimension("dim_service", "p_type", "TypeID", "TypeName")


# --- sources and sinks ---------------------------------------------------------------

def csv_roundtrip(spark, folder):
    path = scratch_path(spark, "csv")
    files.write_csv(table(spark, folder, "customer"), path)
    return files.read_csv(spark, path, CUSTOMER)


def json_roundtrip(spark, folder):
    path = scratch_path(spark, "json")
    files.write_json(table(spark, folder, "customer"), path)
    return files.read_json(spark, path, CUSTOMER)


def parquet_roundtrip(spark, folder):
    path = scratch_path(spark, "parquet")
    files.write_parquet(table(spark, folder, "customer"), path)
    return files.read_parquet(spark, path)


def normalise_missing_(spark, folder):
    events = table(spark, folder, "events")
    return normalise_missing(events, ["event_type", "props"], ("error",))


def key_projection(spark, folder):
    return table(spark, folder, "lineitem", "l_partkey", "l_suppkey")


def json_fields(spark, folder):
    events = table(spark, folder, "events", "event_id", "props")
    return files.parse_documents(events, "props", "k bigint").select("event_id", "k")


def _damaged_events(spark, folder):
    """Events whose documents are partly cut off and partly of another shape."""
    kind, props = F.col("event_type"), F.col("props")
    cut = F.substring(props, F.lit(1), F.length(props) - 1)
    other = F.when(kind == "view", F.lit("[1, 2]")).when(kind == "click", F.lit('{"k": null, "x": 1.5}'))
    damaged = F.when(kind == "error", cut).when(kind == "signup", F.lit('{"k": "many"}'))
    return table(spark, folder, "events").select("event_id", F.coalesce(damaged, other, props).alias("props"))


def json_rejects(spark, folder):
    """Fields of good documents, and why the others are kept apart."""
    read = files.parse_or_reject(_damaged_events(spark, folder), "props", {"k": "bigint"})
    return read.select("event_id", "k", "rejected")


def json_shapes(spark, folder):
    return files.document_shapes(_damaged_events(spark, folder), "props")


def stored_inventory(spark, folder):
    """Objects and their prefixes, from the files that were stored under prefixes."""
    path = scratch_path(spark, "stored")
    events = table(spark, folder, "events").repartition("event_type")
    layout.write_by_prefix(events, path, ["event_type"])
    found = files.inventory(spark, path)
    return found.select(F.substring_index("key", "/", 1).alias("prefix")).distinct()


def _prefixed_events(spark, folder):
    path = scratch_path(spark, "prefixes")
    events = table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    layout.write_by_prefix(events, path, ["event_type", "day"])
    return files.read_parquet(spark, path)


def prefix_layout(spark, folder):
    """Everything written under prefixes, counted per prefix."""
    back = _prefixed_events(spark, folder)
    day = F.col("day").cast("string").alias("day")
    return back.groupBy("event_type", day).agg(
        F.count(F.lit(1)).alias("n_objects"), F.min("event_id").alias("first_id")
    )


def prefix_read(spark, folder):
    """The objects under one prefix; the other prefixes are not opened."""
    return _prefixed_events(spark, folder).where("event_type = 'error'").select(
        "event_id", "event_type", "value"
    )


# --- master data ---------------------------------------------------------------------

def exact_duplicates(spark, folder):
    copies = dedup.exact_duplicates(parts(spark, folder), MATCH, "p_partkey")
    return dedup.sorted_by(copies, "p_name", "p_partkey").select("p_partkey", *MATCH)


def golden_records(spark, folder):
    return dedup.golden_records(parts(spark, folder), MATCH, "p_partkey")


def crosswalk(spark, folder):
    return dedup.crosswalk(parts(spark, folder), MATCH, "p_partkey")


def dedup_counts(spark, folder):
    return dedup.dedup_counts(parts(spark, folder), MATCH)


def distinct_ordered(spark, folder):
    return ranking.distinct_ordered(parts(spark, folder), "p_name", "p_partkey")


def _fuzzy_parts(spark, folder):
    golden = golden_records(spark, folder)
    names = ranking.distinct_ordered(golden, "p_name", "p_partkey")
    return similarity.fuzzy_pairs(names.withColumnRenamed("p_name", "name"))


def fuzzy_pairs(spark, folder):
    return _fuzzy_parts(spark, folder).select(
        "name_a", "name_b", "matched", "total", "ratio", "score"
    )


def fuzzy_head(spark, folder):
    return similarity.fuzzy_head(_fuzzy_parts(spark, folder)).select("name_a", "name_b", "score")


def fuzzy_topk(spark, folder):
    return similarity.fuzzy_topk(_fuzzy_parts(spark, folder)).select("name_a", "name_b", "score")


def fuzzy_urls(spark, folder):
    """Similar page addresses: more and longer names than the parts have."""
    pages = table(spark, folder, "pages", "page_id", "url")
    names = ranking.distinct_ordered(pages, "url", "page_id").withColumnRenamed("url", "name")
    return similarity.fuzzy_pairs(names).select("name_a", "name_b", "matched", "total", "score")


def fuzzy_urls_lossy(spark, folder):
    """How many similar page addresses there are, and whether the lossy mode finds nine tenths."""
    pages = table(spark, folder, "pages", "page_id", "url")
    names = settle(ranking.distinct_ordered(pages, "url", "page_id").withColumnRenamed("url", "name"))
    found = similarity.recall(similarity.lossy_fuzzy_pairs(names), similarity.fuzzy_pairs(names))
    return found.select("n_exact", (F.col("recall") >= 0.9).alias("recalled"))


# --- integrity and remap -------------------------------------------------------------

def _golden_parts(spark, folder):
    return dedup.golden_ids(parts(spark, folder), MATCH, "p_partkey").withColumnRenamed("p_partkey", "id")


def _golden_nations(spark, folder):
    nation = table(spark, folder, "nation")
    return dedup.golden_ids(nation, ["n_regionkey"], "n_nationkey").withColumnRenamed("n_nationkey", "id")


def two_role_keys(spark, folder):
    return integrity.union_keys(
        integrity.key_set(table(spark, folder, "customer"), "c_nationkey"),
        integrity.key_set(table(spark, folder, "supplier"), "s_nationkey"),
    )


def two_role_keys_one_table(spark, folder):
    return integrity.key_set(table(spark, folder, "lineitem"), "l_partkey", "l_suppkey")


def orphans(spark, folder):
    ids = integrity.key_set(table(spark, folder, "lineitem"), "l_partkey")
    return integrity.orphans(ids, _golden_parts(spark, folder))


def orphans_filtered(spark, folder):
    """The same through a filter of the master keys: what is surely no master key is not joined."""
    ids = integrity.key_set(table(spark, folder, "lineitem"), "l_partkey")
    return keyfilter.orphans(ids, _golden_parts(spark, folder))


def unused_filtered(spark, folder):
    return keyfilter.unused(
        integrity.keys(table(spark, folder, "events"), "user_id"),
        integrity.key_set(table(spark, folder, "customer"), "c_custkey"),
    )


def fk_filtered(spark, folder):
    parents = _golden_parts(spark, folder)
    return keyfilter.fk_violations(table(spark, folder, "lineitem"), "l_partkey", parents, "id")


def unused_master(spark, folder):
    """Customers no event refers to."""
    return integrity.unused(
        integrity.key_set(table(spark, folder, "events"), "user_id"),
        integrity.key_set(table(spark, folder, "customer"), "c_custkey"),
    )


def integrity_report(spark, folder):
    used = integrity.keys(table(spark, folder, "customer"), "c_nationkey").union(
        integrity.keys(table(spark, folder, "supplier"), "s_nationkey")
    )
    return integrity.integrity_summary(used, _golden_nations(spark, folder))


def integrity_before_remap(spark, folder):
    ids = integrity.keys(table(spark, folder, "lineitem"), "l_partkey")
    return integrity.integrity_summary(ids, _golden_parts(spark, folder))


def integrity_after_remap(spark, folder):
    """Do all facts point at golden master records once retired keys are replaced?"""
    done = reconcile.reconcile(
        table(spark, folder, "lineitem"), ["l_partkey"], parts(spark, folder), MATCH, "p_partkey"
    )
    return done.report.summary


def remap_keys(spark, folder):
    walk = settle(crosswalk(spark, folder))
    return remap.remap_keys(table(spark, folder, "lineitem"), walk, ["l_partkey"])


def remap_two_roles(spark, folder):
    walk = settle(crosswalk(spark, folder))
    return remap.remap_keys(table(spark, folder, "lineitem"), walk, ["l_partkey", "l_suppkey"])


def remap_literal(spark, folder):
    return remap.remap_literal(table(spark, folder, "part"), {11: 3, 19: 3, 42: 40}, ["p_partkey"])


# --- star and constraints ------------------------------------------------------------

def dim_borough(spark, folder):
    """The brand dimension, its null member included."""
    return star.build_dimension(parts(spark, folder), "p_partkey", BRAND)


def dim_service(spark, folder):
    """The part-type dimension."""
    return star.build_dimension(parts(spark, folder), "p_partkey", KIND)


def star_dim(spark, folder):
    return star.build_star(parts(spark, folder), "p_partkey", ["p_name"], [BRAND, KIND], "dim_part")["dim_part"]


def star_head(spark, folder):
    return star_dim(spark, folder).orderBy("p_partkey").limit(5)


def _published_star(spark, folder, store):
    """Publish the star, then read it as anybody would: every part with its labels."""
    star_load.load_star(
        spark, golden_records(spark, folder), "p_partkey", ["p_name"], [BRAND, KIND], "dim_part", store
    )
    rows = publish.published(spark, store, "dim_part")
    for spec in (BRAND, KIND):
        rows = rows.join(publish.published(spark, store, spec.name), spec.id_name)
    return rows.select("p_partkey", "p_name", BRAND.label, KIND.label)


def star_publish(spark, folder):
    """Files of a star whose keys were checked before readers were pointed to them."""
    return _published_star(spark, folder, publish.ParquetStore(scratch_path(spark, "star")))


def star_publish_tables(spark, folder):
    """The same through catalog tables and views."""
    prefix = scratch_path(spark, "star").rsplit("/", 1)[-1].replace("-", "_")
    return _published_star(spark, folder, publish.CatalogStore(prefix=prefix + "_"))


def pk_violations(spark, folder):
    return constraints.pk_violations(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_violations(spark, folder):
    lines = table(spark, folder, "lineitem")
    return constraints.fk_violations(lines, "l_partkey", _golden_parts(spark, folder), "id")


def _stored_lines(spark, folder, *columns):
    """Counts of line-item keys, loaded as one batch per way of return; one is loaded twice."""
    stored = keycounts.KeyCounts(spark, scratch_table("key_counts"), columns, buckets=32)
    rows = table(spark, folder, "lineitem", "l_returnflag", *columns)
    for flag in ("A", "N", "A"):
        stored.load(flag, rows.where(F.col("l_returnflag") == flag))
    stored.load("other", rows.where(~F.coalesce(F.col("l_returnflag").isin("A", "N"), F.lit(False))))
    return stored


def pk_over_batches(spark, folder):
    """Suppliers that one part has in several lines, whichever batches those came in."""
    return _stored_lines(spark, folder, "l_partkey", "l_suppkey").pk_violations()


def fk_over_batches(spark, folder):
    parents = _golden_parts(spark, folder)
    return _stored_lines(spark, folder, "l_partkey").fk_violations(parents, "id")


def integrity_stored(spark, folder):
    """Both reports of the part keys, before and after the remap, from their stored counts."""
    stored = _stored_lines(spark, folder, "l_partkey")
    done = reconcile.check_stored(stored, parts(spark, folder), MATCH, "p_partkey")
    before = done.before.summary.select(F.lit("before").alias("remap"), "*")
    return before.unionByName(done.after.summary.select(F.lit("after").alias("remap"), "*"))


# --- profiles ------------------------------------------------------------------------

def entity_profile(spark, folder):
    return profile.entity_profile(
        {
            "part": ("master", table(spark, folder, "part")),
            "nation": ("reference", table(spark, folder, "nation")),
            "lineitem": ("transactional", table(spark, folder, "lineitem")),
        }
    )


def schema_profile(spark, folder):
    names = ("part", "lineitem", "events")
    return profile.schema_profile({name: table(spark, folder, name) for name in names})


def reference_values(spark, folder):
    lines = table(spark, folder, "lineitem")
    return profile.reference_values(lines, ["l_returnflag", "l_linestatus", "l_linenumber"])


# --- governance ----------------------------------------------------------------------

def object_inventory(spark, folder):
    return objects(spark, folder)


def retention_expired(spark, folder):
    rules = governance.read_lifecycle(LIFECYCLE)
    return governance.retention_expired(objects(spark, folder), rules, AS_OF).select("key", "rule_id")


def grant_check(spark, folder):
    grants = governance.read_policy(POLICY)
    return governance.grant_check(objects(spark, folder), grants, "s3:GetObject", RESOURCE_ROOT, "auditor")


def prefix_rules(spark, folder):
    """Longest of thousands of prefixes, read from a table."""
    return rule_tables.longest_prefix(objects(spark, folder), rules(spark, folder))


def retention_rules(spark, folder):
    """Retention by a table of rules."""
    found = rule_tables.retention_expired_by(objects(spark, folder), rules(spark, folder), AS_OF)
    return found.select("key", "rule_id")


def grant_rules(spark, folder):
    """Read access by a table of grants with wildcards."""
    return rule_tables.grant_check_by(
        objects(spark, folder), rules(spark, folder), "s3:GetObject", RESOURCE_ROOT, "auditor"
    )


def tags_to_map_(spark, folder):
    tagged = objects(spark, folder).select("key", tags_to_map(F.col("tags")).alias("tags"))
    return tagged.select(
        "key",
        *[F.col("tags")[t].alias(t.lower()) for t in ("Owner", "Classification", "Domain")],
        F.size("tags").cast("long").alias("n_tags"),
    )


def tags_exploded(spark, folder):
    return governance.tags_exploded(objects(spark, folder))


def tag_violations(spark, folder):
    return governance.tag_violations(objects(spark, folder))


def manifest_prefixes(spark, folder):
    manifest = governance.read_manifest(MANIFEST)
    row = governance.manifest_row(spark, manifest)
    return governance.manifest_usage(objects(spark, folder), row, manifest["prefixes"])


def prefix_purpose(spark, folder):
    return governance.prefix_purpose(objects(spark, folder), governance.read_manifest(MANIFEST)["prefixes"])


def prefix_usage(spark, folder):
    return governance.prefix_usage(objects(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__.rstrip("_"): f
    for f in (
        csv_roundtrip, json_roundtrip, parquet_roundtrip, normalise_missing_, key_projection,
        json_fields, json_rejects, json_shapes, stored_inventory, prefix_layout, prefix_read,
        exact_duplicates, golden_records, crosswalk, dedup_counts, distinct_ordered,
        fuzzy_pairs, fuzzy_head, fuzzy_topk, fuzzy_urls, fuzzy_urls_lossy,
        two_role_keys, two_role_keys_one_table, orphans, orphans_filtered, unused_master, unused_filtered, integrity_report,
        integrity_before_remap, integrity_after_remap, remap_keys, remap_two_roles, remap_literal,
        dim_borough, dim_service, star_dim, star_head, star_publish, star_publish_tables, pk_violations, fk_violations,
        fk_filtered, pk_over_batches, fk_over_batches, integrity_stored,
        entity_profile, schema_profile, reference_values,
        object_inventory, retention_expired, grant_check, prefix_rules, retention_rules, grant_rules, tags_to_map_, tags_exploded,
        tag_violations, manifest_prefixes, prefix_purpose, prefix_usage,
    )
}
