"""Cleanse a master table: duplicates out, golden records and look-alikes reported."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from goldkeep.operators.dedup import dedup_counts, exact_duplicates, golden_records, sorted_by
from goldkeep.operators.ranking import distinct_ordered
from goldkeep.operators.similarity import fuzzy_pairs, rejected_names


class Cleansed(NamedTuple):
    golden: DataFrame
    duplicates: DataFrame
    counts: DataFrame
    similar: DataFrame
    rejected: DataFrame


def cleanse(
    master: DataFrame, match: list[str], key: str, name: str, threshold: float = 0.85
) -> Cleansed:
    """Golden records, all copies sorted by ``name``, counts, similar golden
    names, and names that are too long to be compared."""
    golden = golden_records(master, match, key)
    names = distinct_ordered(golden, name, key).withColumnRenamed(name, "name")
    return Cleansed(
        golden,
        sorted_by(exact_duplicates(master, match, key), name, key),
        dedup_counts(master, match),
        fuzzy_pairs(names, threshold),
        rejected_names(names),
    )
