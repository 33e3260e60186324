"""The test tables in the roles the operators expect."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldkeep.operators.governance import object_key
from goldkeep.sources.files import read_parquet

MATCH = ["p_name", "p_brand"]
AS_OF = datetime(2024, 2, 10)

# Own rules over the inventory made below. Field names are those of the public formats.
POLICY = """{"Version": "2012-10-17", "Statement": [
  {"Sid": "Auditors", "Effect": "Allow", "Principal": {"AWS": ["auditor", "steward"]},
   "Action": ["s3:GetObject", "s3:ListBucket"],
   "Resource": ["arn:aws:s3:::vault/ledger/purchase/*", "arn:aws:s3:::vault/ledger/error/1*"]},
  {"Sid": "Everyone", "Effect": "Allow", "Principal": "*", "Action": "s3:Get*",
   "Resource": "arn:aws:s3:::vault/open/view/*"}]}"""
RESOURCE_ROOT = "arn:aws:s3:::vault/"

LIFECYCLE = """{"Rules": [
  {"ID": "short-lived", "Status": "Enabled", "Filter": {"Prefix": "open/click/"}, "Expiration": {"Days": 12}},
  {"ID": "yearly", "Status": "Enabled", "Filter": {"Prefix": "ledger/"}, "Expiration": {"Days": 365}},
  {"ID": "paused", "Status": "Disabled", "Filter": {"Prefix": ""}, "Expiration": {"Days": 1}}]}"""

MANIFEST = """
bucket_info:
  name: vault
  created_at: "2023-11-20"
  region: north-1
ownership:
  department: Records
  primary_owner: Head of records
  contact_email: records@example.org
governance:
  classification: Internal
  purpose: Keeps what customers did and what it cost
  retention_policy: Clicks go after twelve days, ledgers after a year
  pii_content: true
prefixes:
  ledger/: money and failures
  ledger/purchase/: sales ledger
  open/: free to look at
  attic/: nothing yet
"""


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet", list(columns) or None)


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Master: parts, one brand read as missing so that null match values occur."""
    return table(spark, folder, "part").withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#2")))


def objects(spark: SparkSession, folder: str) -> DataFrame:
    """Inventory: one object per event, ``(key, ts, size, tags)``."""
    kind = F.col("event_type")
    place = F.when(kind.isin("purchase", "error"), "ledger").otherwise("open")
    secrecy = (
        F.when(kind == "purchase", "Secret").when(kind == "error", "Internal")
        .when(kind == "signup", "Other").otherwise("Public")
    )
    domain = F.when(kind == "purchase", "Finance").when(kind == "signup", "HR").otherwise("Eng")
    tags = F.concat(
        F.lit("Owner=user"), "user_id", F.lit("&Classification="), secrecy, F.lit("&Domain="), domain
    )
    return table(spark, folder, "events").select(
        object_key(place, kind, F.col("event_id").cast("string")).alias("key"),
        "ts",
        F.length("props").cast("long").alias("size"),
        tags.alias("tags"),
    )


KINDS = ("open/click/", "open/view/", "open/signup/", "ledger/purchase/", "ledger/error/")


def rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules by the thousand: each customer governs the objects of one kind whose number begins
    with the customer's, so prefixes of several lengths fit one object."""
    nation, number = F.col("c_nationkey"), F.col("c_custkey").cast("string")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), nation % 5 + 1)
    prefix = F.concat(kind, number)
    pattern = (
        F.when(nation % 3 == 0, F.concat(prefix, F.lit("*")))
        .when(nation % 3 == 1, F.concat(kind, F.lit("?"), number))
        .otherwise(F.concat(prefix, F.lit("?*7")))
    )
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("rule_id"),
        prefix.alias("prefix"),
        F.col("c_mktsegment").alias("purpose"),
        (F.col("c_custkey") % 40 + 1).cast("int").alias("days"),
        (nation > 2).alias("enabled"),
        F.when(nation < 12, "auditor").when(nation < 18, "steward").otherwise("*").alias("principal"),
        F.when(nation < 20, "s3:Get*").otherwise("s3:PutObject").alias("action"),
        F.concat(F.lit(RESOURCE_ROOT), pattern).alias("resource"),
    )
