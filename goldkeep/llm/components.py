"""Connected components of a graph that is too large for one machine.

Large-star and small-star rounds shorten all paths until every node points at the smallest node
of its component. A round is two groupings with map-side minima and two lookups on narrow rows
(:func:`~goldkeep.operators.joins.attach`, which spreads nodes with many edges); the number of
rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.operators.joins import BROADCAST_BYTES, attach
from goldkeep.shared import settle

#: Bytes of a node and its minimum on their way to every task.
ROW_BYTES = 32


def _lookup(rows: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    """``rows`` with ``m`` of their ``u``; ``small`` says the minima fit into a broadcast."""
    if small:
        return rows.join(F.broadcast(least), "u")
    return attach(rows, settle(least), {"u": "u"}, how="inner")


def _large_star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = _lookup(both.where("v > u"), least, small)
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, small: bool) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = _lookup(down, least, small).where("v <> m")
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node of ``edges`` (two integer columns), the smallest
    node of a component being its name. Loops and repeated edges make no difference."""
    u, v = edges.columns
    current = settle(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where("u <> v")
        .distinct()
    )
    # a round never adds edges, and an edge has two nodes
    state = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")))
    before = current.agg(state.alias("state")).first()["state"]
    while True:
        small = 2 * before["n"] * ROW_BYTES <= BROADCAST_BYTES
        current = settle(_small_star(_large_star(current, small), small))
        now = current.agg(state.alias("state")).first()["state"]
        if now == before:
            break
        before = now
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(roots)
