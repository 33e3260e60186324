"""Referential integrity between fact keys and master keys.

Keys are one-column frames named ``id``; a key set is one without repeats. A null fact key
is an orphan: it matches no master key.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.shared import settle


class IntegrityReport(NamedTuple):
    """The summary is one row; the key lists stay distributed, however long they are."""

    summary: DataFrame
    orphans: DataFrame
    unused: DataFrame


def keys(df: DataFrame, *columns: str) -> DataFrame:
    """All values of one or more key columns of a table, in one scan."""
    if len(columns) == 1:
        return df.select(F.col(columns[0]).alias("id"))
    return df.select(F.explode(F.array(*columns)).alias("id"))


def key_set(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of one or more key columns of a table."""
    return keys(df, *columns).distinct()


def union_keys(*key_sets: DataFrame) -> DataFrame:
    """Distinct keys of several key sets."""
    return reduce(DataFrame.union, key_sets).distinct()


def orphans(facts: DataFrame, master: DataFrame) -> DataFrame:
    """Keys of the fact key set without a master record."""
    return facts.join(master, "id", "left_anti")


def unused(facts: DataFrame, master: DataFrame) -> DataFrame:
    """Keys of the master key set no fact refers to."""
    return master.join(facts, "id", "left_anti")


def _presence(facts: DataFrame, master: DataFrame) -> DataFrame:
    """``id, _fact, _master``: every key with the sides it is on; keys may repeat.

    Both sides are stacked and grouped by key, which needs one shuffle and no join. Null
    keys of the two sides are kept apart because they do not match each other.
    """
    def side(ids: DataFrame, in_fact: int) -> DataFrame:
        return ids.select(
            "id",
            F.when(F.col("id").isNull(), F.lit(in_fact)).alias("_apart"),
            F.lit(in_fact).alias("_fact"),
            F.lit(1 - in_fact).alias("_master"),
        )

    return (
        side(facts, 1)
        .union(side(master, 0))
        .groupBy("id", "_apart")
        .agg(F.max("_fact").alias("_fact"), F.max("_master").alias("_master"))
    )


_ORPHAN, _IDLE = "_fact = 1 and _master = 0", "_fact = 0 and _master = 1"


def _summary(present: DataFrame) -> DataFrame:
    counts = present.agg(
        F.count_if(F.expr(_ORPHAN)).alias("orphan_ids"),
        F.count_if(F.expr("_fact = 1")).alias("fact_ids"),
        F.count_if(F.expr("_master = 1")).alias("golden_ids"),
        F.count_if(F.expr(_IDLE)).alias("unused_ids"),
    )
    status = F.when(F.col("orphan_ids") == 0, "SUCCESS").otherwise("ALERT").alias("status")
    return counts.select(status, "*")


def integrity_summary(facts: DataFrame, master: DataFrame) -> DataFrame:
    """One row: status, orphan, fact, golden and unused key counts; keys may repeat."""
    return _summary(_presence(facts, master))


def integrity_report(facts: DataFrame, master: DataFrame) -> IntegrityReport:
    """Summary plus the orphaned and unused keys as frames; keys may repeat.

    The facts are read once: all three come from one settled row per key.
    """
    present = settle(_presence(facts, master))
    return IntegrityReport(
        _summary(present),
        present.where(_ORPHAN).select("id"),
        present.where(_IDLE).select("id"),
    )
