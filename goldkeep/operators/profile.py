"""Profiles of master, reference and transactional tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_profile(tables: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Row count of each table, plain and with thousands separators.

    ``tables`` maps a name to its class (master, reference, transactional) and frame.
    """
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(kind).alias("entity_class"),
            "n_rows",
            F.format_number("n_rows", 0).alias("n_rows_text"),
        )
        for name, (kind, df) in tables.items()
    ]
    return reduce(DataFrame.union, counted)


def schema_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns of each table in order, with their type and the table's row count."""

    def listing(name: str, df: DataFrame) -> DataFrame:
        columns = F.array(
            *[
                F.struct(
                    F.lit(i).cast("long").alias("position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("column_type"),
                )
                for i, f in enumerate(df.schema.fields)
            ]
        )
        rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
        return rows.select(F.lit(name).alias("table_name"), "n_rows", F.inline(columns))

    return reduce(DataFrame.union, [listing(name, df) for name, df in tables.items()])


def reference_values(df: DataFrame, columns: list[str], drop_nulls: list[str] = ()) -> DataFrame:
    """Distinct values of each reference column with their row counts, in one scan.

    Values are text, so columns of different types fit one frame; numbers still sort as
    numbers. Nulls count as a value except in ``drop_nulls``.
    """
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    values = df.select(F.inline(cells)).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    if drop_nulls:
        values = values.where(F.col("value").isNotNull() | ~F.col("column_name").isin(*drop_nulls))
    number = F.expr("try_cast(value as double)")
    return values.orderBy("column_name", F.asc_nulls_last(number), F.asc_nulls_last("value"))
