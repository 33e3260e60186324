"""Contiguous shards of near-equal bytes.

Rows are ordered by id (then checksum and size), laid out in that order over range
partitions, and given the sum of all sizes before them: a running sum inside each partition
plus the totals of the partitions before it. Only one row per partition meets in one place.
Shards are cut where the running sum passes equal shares of the total, so each shard is a
contiguous stretch of the order and differs from the equal share by at most one row.

Results for unusual input: a null text weighs as an empty one; a null id comes first; equal
rows lie side by side and may be parted; an empty table gives no rows; columns of the input
other than id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldkeep.shared import settle


def placed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id, ``size``, ``text_crc32`` of every row with ``bytes_before`` and ``rows_before``:
    the bytes and rows before it in the global order, and ``bytes_total``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    measured = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("text_crc32"), F.asc("size")]
    # the cut points of a range exchange come from a sample: settle the layout before use
    laid = settle(measured.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    totals = laid.groupBy("part").agg(
        F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # one row per partition: the only thing that meets in one task, and small enough to send
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("part_bytes_before"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("part_rows_before"),
        F.sum("part_bytes").over(everything).alias("bytes_total"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    within = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        laid.withColumn("bytes_inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .withColumn("rows_inside", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "part")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("bytes_inside") + F.col("part_bytes_before")).alias("bytes_before"),
            (F.col("rows_inside") + F.col("part_rows_before")).alias("rows_before"),
            "bytes_total",
        )
    )


def shard_by_bytes(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row with its ``shard`` and its place there, ``slot``.

    A row belongs to the shard in whose share the middle of its bytes falls.
    """
    rows = placed(docs, id_column, text_column)
    shard = F.expr(
        f"cast(2 * bytes_before + size as decimal(28,0)) * {int(shards)} div (2 * bytes_total)"
    ).cast("int")
    cut = settle(rows.withColumn("shard", shard))
    starts = cut.groupBy("shard").agg(F.min("rows_before").alias("shard_start"))
    return cut.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("rows_before") - F.col("shard_start")).cast("long").alias("slot"),
    )
