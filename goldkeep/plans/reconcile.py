"""Repair facts that point at retired master records and prove the repair."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from goldkeep.operators.dedup import crosswalk, golden_ids
from goldkeep.operators.integrity import IntegrityReport, integrity_report, keys
from goldkeep.operators.keycounts import KeyCounts
from goldkeep.operators.remap import remap_keys
from goldkeep.shared import settle


class Reconciled(NamedTuple):
    facts: DataFrame
    crosswalk: DataFrame
    report: IntegrityReport


def reconcile(
    facts: DataFrame, columns: list[str], master: DataFrame, match: list[str], key: str
) -> Reconciled:
    """Derive the crosswalk of ``master``, remap ``columns`` of ``facts``, check the result.

    The report is taken after the remap: orphans that remain were never in the master.
    """
    walk = settle(crosswalk(master, match, key))
    remapped = remap_keys(facts, walk, columns)
    golden = golden_ids(master, match, key).withColumnRenamed(key, "id")
    return Reconciled(remapped, walk, integrity_report(keys(remapped, *columns), golden))


class Checked(NamedTuple):
    crosswalk: DataFrame
    before: IntegrityReport
    after: IntegrityReport


def check_stored(stored: KeyCounts, master: DataFrame, match: list[str], key: str) -> Checked:
    """What :func:`reconcile` reports, before and after the remap, from the stored keys of a column.

    The facts are not read: both checks and the remap work on one row per key.
    """
    walk = settle(crosswalk(master, match, key))
    golden = settle(golden_ids(master, match, key).withColumnRenamed(key, "id"))
    ids = stored.key_ids()
    return Checked(
        walk, integrity_report(ids, golden), integrity_report(remap_keys(ids, walk, ["id"]), golden)
    )
