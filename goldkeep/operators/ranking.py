"""Dense 0-based numbers for distinct values in first-appearance order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldkeep.shared import settle


def dense_index(df: DataFrame, order: str, name: str) -> DataFrame:
    """Number the rows of ``df`` 0, 1, 2, ... by the unique column ``order``.

    The rows are sorted over all partitions and settled with their partition and place in
    it, so both are final. Places are then shifted by the size of the partitions before:
    only one row per partition meets in a single task.
    """
    placed = settle(df.orderBy(order).select("*", F.monotonically_increasing_id().alias("_at")))
    # fixed values: the id holds the partition above bit 33 and the place below
    placed = placed.select(
        *df.columns,
        F.shiftright("_at", 33).alias("_part"),
        F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"),
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    starts = sizes.select(F.col("_part").alias("_of"), start)
    numbered = placed.join(F.broadcast(starts), F.col("_part") == F.col("_of"))
    return numbered.select(*df.columns, (F.col("_start") + F.col("_place")).alias(name))


def distinct_ordered(df: DataFrame, column: str, key: str, name: str = "ord") -> DataFrame:
    """Distinct non-null values of ``column`` and their 0-based order of first appearance."""
    return members(df.where(F.col(column).isNotNull()), column, key, column, name)


def members(df: DataFrame, column: str, key: str, label: str, name: str) -> DataFrame:
    """Distinct values of ``column``, null included, numbered by their smallest key."""
    first = df.groupBy(F.col(column).alias(label)).agg(F.min(key).alias("_first"))
    return dense_index(first, "_first", name).select(label, name)
