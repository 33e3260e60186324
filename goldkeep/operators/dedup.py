"""Exact duplicates, golden records and the crosswalk from retired to golden keys.

Rows are copies of each other when they agree on the match columns, null agreeing with
null. The golden record of a group is the one with the smallest key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldkeep.operators.joins import attach, fits_broadcast, heaviest
from goldkeep.shared import settle


def _duplicate_groups(df: DataFrame, keys: list[str], key: str) -> DataFrame:
    """One row per group with copies: its match columns, size and smallest key."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_copies"), F.min(key).alias("_golden"))
        .where("_copies > 1")
    )


def _mark(df: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` in one of ``groups``, with its ``_golden``; large groups are known."""
    table = groups.drop("_copies")
    small = fits_broadcast(table)
    heavy = None if small else heaviest(groups, keys, "_copies")
    on = {c: c for c in keys}
    return attach(df, table, on, how="inner", null_safe=True, small=small, heavy=heavy)


def exact_duplicates(df: DataFrame, keys: list[str], key: str) -> DataFrame:
    """All rows of groups with more than one copy, including the golden one.

    Groups are counted with map-side combining and the few match columns are joined back,
    so a group holding a large share of the rows is never gathered in one task.
    """
    groups = settle(_duplicate_groups(df, keys, key))
    return _mark(df, groups, keys).drop("_golden")


def sorted_by(df: DataFrame, column: str, key: str) -> DataFrame:
    """Order by one column, nulls last; the key breaks ties."""
    return df.orderBy(F.asc_nulls_last(column), F.asc(key))


def golden_records(df: DataFrame, keys: list[str], key: str) -> DataFrame:
    """The row with the smallest key of every group.

    Spark limits each group to one row before the shuffle, so only group winners move.
    """
    order = Window.partitionBy(*keys).orderBy(key)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def golden_ids(df: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Only the keys of the golden records, by a plain aggregate."""
    return df.groupBy(*keys).agg(F.min(key).alias("_golden")).select(F.col("_golden").alias(key))


def crosswalk(df: DataFrame, keys: list[str], key: str) -> DataFrame:
    """``(retired_id, golden_id)`` for every record that is not golden."""
    groups = settle(_duplicate_groups(df, keys, key))
    marked = _mark(df.select(key, *keys), groups, keys)
    return marked.where(F.col(key) != F.col("_golden")).select(
        F.col(key).alias("retired_id"), F.col("_golden").alias("golden_id")
    )


def dedup_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows before, golden and retired rows, rows that have a copy."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    def total(column):
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return sizes.agg(
        total(F.col("n")).alias("original_rows"),
        F.count(F.lit(1)).alias("golden_rows"),
        total(F.col("n") - 1).alias("retired_rows"),
        total(F.when(F.col("n") > 1, F.col("n"))).alias("duplicate_rows"),
    )
