"""Build the star of a master table and publish it once its keys hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from goldkeep.operators.star import Dimension, build_star
from goldkeep.sources.publish import CatalogStore, ForeignKey, ParquetStore, PrimaryKey, publish


def load_star(
    spark: SparkSession,
    master: DataFrame,
    key: str,
    keep: list[str],
    dimensions: list[Dimension],
    name: str,
    store: ParquetStore | CatalogStore,
) -> dict[str, DataFrame]:
    """Publish one table per dimension and the normalised master ``name``."""
    tables = build_star(master, key, keep, dimensions, name)
    primary = [PrimaryKey(d.name, [d.id_name]) for d in dimensions] + [PrimaryKey(name, [key])]
    foreign = [ForeignKey(name, d.id_name, d.name, d.id_name) for d in dimensions]
    return publish(spark, tables, store, primary, foreign)
