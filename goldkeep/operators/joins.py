"""Key lookups that neither shuffle a fact table needlessly nor pile a hot key on one task.

``attach`` adds the columns of a lookup table (unique on its key) to every row of a table.
How depends on the measured size of the lookup:

* small: broadcast it, the rows stay where they are;
* large: the lookup rows of the most frequent keys are broadcast to the rows that need them;
  all rows go through a shuffle join, in which those already served are spread over all tasks
  and the others are looked up. A key outside the heavy list holds less than one part in
  ``HEAVY_PER_TASK`` of a task's share, so no task gets much more than its share. The result
  is exactly the plain join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldkeep.shared import settle

#: Largest lookup, in measured bytes, that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
#: Largest measured size of the lookup rows of heavy keys, for the same.
SERVED_BYTES = 64 * 1024 * 1024
#: Heaviest keys that are spread when the lookup is large, for each task of a shuffle.
HEAVY_PER_TASK = 4


def measured_bytes(df: DataFrame) -> int:
    """Raw size of the values of ``df``: text by its length, all else 16 bytes a value."""
    width: Column = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            width = width + 16
    return df.agg(F.sum(width.cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Whether the measured size of ``df`` is within the broadcast bound."""
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def match(left: DataFrame, right: DataFrame, on: dict[str, str], null_safe: bool) -> Column:
    """Join condition over ``{left column: right column}``."""
    parts = [
        left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in on.items()
    ]
    return reduce(lambda x, y: x & y, parts)


def heavy_limit(spark: SparkSession) -> int:
    """How many keys can hold more than one part in ``HEAVY_PER_TASK`` of a task's share."""
    return HEAVY_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that hold at least one part in :func:`heavy_limit` of all rows."""
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return heaviest(counted, keys, "_rows", rows.count())


def heaviest(counted: DataFrame, keys: list[str], count: str, total: int | None = None) -> DataFrame:
    """The same from a table that has each key once with its ``count``; ``total`` is their sum.

    Keys are compared with a share of the total and not with one another, so nothing is sorted,
    and no more than :func:`heavy_limit` keys can have such a share.
    """
    if total is None:
        total = counted.agg(F.sum(count)).first()[0] or 0
    least = max(2, -(-total // heavy_limit(counted.sparkSession)))
    return settle(counted.where(F.col(count) >= least).select(*keys))


def heavy_keys_each(rows: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """The heavy keys of every column, each counted on that column alone."""
    total = rows.count()
    found = {}
    for column in columns:
        counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
        found[column] = heaviest(counted, [column], "_rows", total)
    return found


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    *,
    how: str = "left",
    null_safe: bool = False,
    broadcast_bytes: int | None = None,
    small: bool | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Add the non-key columns of ``lookup`` to ``rows``.

    ``on`` maps columns of ``rows`` to key columns of ``lookup``, which must be unique.
    ``how`` is ``left`` or ``inner``; with ``null_safe`` a null key matches a null key.
    ``lookup`` is read several times: settle it first when it is costly. Who knows already
    whether it is ``small`` enough for a broadcast, or which keys of ``rows`` are ``heavy``
    (columns as in ``rows``), can say so.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    renamed = {key: f"_lookup_{i}" for i, key in enumerate(on.values())}
    table = lookup.select(*[F.col(c).alias(renamed.get(c, c)) for c in lookup.columns])
    on = {a: renamed[b] for a, b in on.items()}
    key_columns = list(renamed.values())

    if small is None:
        small = fits_broadcast(table, broadcast_bytes)
    if small:
        joined = rows.join(F.broadcast(table), match(rows, table, on, null_safe), how)
        return joined.drop(*key_columns)

    if heavy is None:
        heavy = heavy_keys(rows, list(on))
    return _attach_spread(rows, table, on, how, null_safe, heavy)


def _attach_spread(
    rows: DataFrame,
    table: DataFrame,
    on: dict[str, str],
    how: str,
    null_safe: bool,
    heavy: DataFrame,
) -> DataFrame:
    """The join with a large ``table``, heavy keys served from a broadcast."""
    values = [c for c in table.columns if c not in on.values()]
    heavy_on = {a: f"_heavy_{i}" for i, a in enumerate(on)}
    heavy = heavy.withColumnsRenamed(heavy_on)
    known = table.withColumn("_known", F.lit(True))
    to_table = {heavy_on[a]: b for a, b in on.items()}
    served = heavy.join(known, match(heavy, known, to_table, null_safe), "left").select(
        *heavy_on.values(),
        F.lit(True).alias("_heavy"),
        F.col("_known").alias("_served"),
        *[F.col(c).alias(f"_served_{c}") for c in values],
    )
    served = settle(served)
    if not fits_broadcast(served, SERVED_BYTES):  # few rows, but wide ones: leave them to the shuffle
        served = served.limit(0)
    marked = rows.join(F.broadcast(served), match(rows, served, heavy_on, True), "left")

    # equal keys have equal slots, but a heavy row gets one no lookup row has, by partition
    types = {f.name: f.dataType for f in table.schema.fields}
    slot = F.hash(*[F.col(a).cast(types[b]) for a, b in on.items()]).cast("long")
    away = F.when(F.col("_heavy"), F.spark_partition_id() + 1).otherwise(0)
    left = marked.withColumn("_slot", slot + away)
    right = known.select(
        *on.values(),
        F.hash(*on.values()).cast("long").alias("_table_slot"),
        F.col("_known").alias("_found"),
        *[F.col(c).alias(f"_found_{c}") for c in values],
    )
    same_key = match(left, right, on, null_safe)
    joined = left.join(right, same_key & (left["_slot"] == right["_table_slot"]), "left")
    if how == "inner":
        joined = joined.where(F.coalesce("_served", "_found"))
    return joined.select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(f"_served_{c}", f"_found_{c}").alias(c) for c in values],
    )
