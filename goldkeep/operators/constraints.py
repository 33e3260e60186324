"""Primary- and foreign-key checks as jobs that return the violating keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are repeated or hold a null, with their row count."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(missing | (F.col("n_rows") > 1))


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys absent from the parent, with the number of child rows.

    Child rows are counted per key before the anti-join, so only distinct keys are joined.
    """
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("id"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counted.join(parent.select(F.col(parent_key).alias("id")), "id", "left_anti")
