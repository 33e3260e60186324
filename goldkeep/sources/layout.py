"""Files laid out under key prefixes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_by_prefix(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write one folder per combination of ``columns``.

    Rows are rebalanced by folder first: Spark merges small folders into full files and
    splits a folder that holds a large share of the rows over several tasks.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)
