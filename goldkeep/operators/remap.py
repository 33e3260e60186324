"""Point fact keys at golden records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.operators.joins import attach, fits_broadcast, heavy_keys_each


def crosswalk_violations(crosswalk: DataFrame) -> DataFrame:
    """Crosswalk keys that make a remap ambiguous: retired twice, or retired and a target."""
    retired = crosswalk.select(
        F.col("retired_id").alias("id"), F.lit(1).alias("_retired"), F.lit(0).alias("_target")
    )
    target = crosswalk.select(F.col("golden_id").alias("id"), F.lit(0), F.lit(1))
    problem = F.when(F.col("_retired") > 1, "retired twice").when(
        (F.col("_retired") == 1) & (F.col("_target") == 1), "target is itself retired"
    )
    roles = (
        retired.union(target)
        .groupBy("id")
        .agg(F.sum("_retired").alias("_retired"), F.max("_target").alias("_target"))
    )
    return roles.select("id", problem.alias("problem")).where(F.col("problem").isNotNull())


def remap_keys(
    facts: DataFrame,
    crosswalk: DataFrame,
    columns: list[str],
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Replace retired keys by golden ones in each of ``columns``; other keys stay.

    Every column is looked up once in the original crosswalk, so replacements never chain.
    The crosswalk is read several times and should be settled.
    """
    bad = crosswalk_violations(crosswalk).head(5)
    if bad:
        raise ValueError(f"crosswalk is not usable, for example: {[tuple(r) for r in bad]}")
    walk = crosswalk.select(F.col("retired_id").alias("_retired"), F.col("golden_id").alias("_golden"))
    small = fits_broadcast(walk, broadcast_bytes)
    # counted on the facts as they come, not on what earlier lookups have made of them
    heavy = {} if small else heavy_keys_each(facts, columns)
    for column in columns:
        found = attach(facts, walk, {column: "_retired"}, small=small, heavy=heavy.get(column))
        golden = F.coalesce("_golden", column).alias(column)
        facts = found.select(*[golden if c == column else F.col(c) for c in facts.columns])
    return facts


def remap_literal(df: DataFrame, mapping: dict, columns: list[str]) -> DataFrame:
    """Replace values by a short literal map, all at once."""
    return df.replace(mapping, subset=columns)
