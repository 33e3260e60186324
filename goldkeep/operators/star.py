"""Normalise a master table into dimensions with surrogate keys."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from goldkeep.operators.joins import attach, fits_broadcast, heavy_keys_each
from goldkeep.operators.ranking import members
from goldkeep.shared import settle


class Dimension(NamedTuple):
    """``column`` of the master becomes a table ``name(id_name, label)``."""

    name: str
    column: str
    id_name: str
    label: str


def build_dimension(master: DataFrame, key: str, dimension: Dimension) -> DataFrame:
    """Members of the dimension, a null member included, numbered by first appearance."""
    found = members(master, dimension.column, key, dimension.label, dimension.id_name)
    return found.select(dimension.id_name, dimension.label)


def star_dim(
    master: DataFrame,
    key: str,
    keep: list[str],
    dimensions: list[tuple[Dimension, DataFrame]],
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """The master with each dimension column replaced by its surrogate key.

    Null members match null values, so no master row is lost.
    """
    small = {spec.name: fits_broadcast(table, broadcast_bytes) for spec, table in dimensions}
    large = [spec.column for spec, _ in dimensions if not small[spec.name]]
    # counted on the master as it comes, not on what earlier lookups have made of it
    heavy = heavy_keys_each(master, large) if large else {}
    for spec, table in dimensions:
        master = attach(
            master,
            table,
            {spec.column: spec.label},
            how="inner",
            null_safe=True,
            small=small[spec.name],
            heavy=heavy.get(spec.column),
        )
    return master.select(key, *keep, *[spec.id_name for spec, _ in dimensions])


def build_star(
    master: DataFrame, key: str, keep: list[str], dimensions: list[Dimension], name: str
) -> dict[str, DataFrame]:
    """All tables of the star, parents first."""
    tables = {spec.name: settle(build_dimension(master, key, spec)) for spec in dimensions}
    tables[name] = star_dim(master, key, keep, [(spec, tables[spec.name]) for spec in dimensions])
    return tables
