"""Tag strings of the form ``key=value&key=value``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _name(pair: Column) -> Column:
    return F.substring_index(pair, "=", 1)


def _value(pair: Column) -> Column:
    return F.when(F.instr(pair, "=") > 0, F.substr(pair, F.instr(pair, "=") + 1))


def _written(tags: Column) -> Column:
    return F.split(tags, "&")


def tag_pairs(tags: Column) -> Column:
    """Array of ``(tag, value)`` in written order, repeats kept."""
    pairs = F.transform(
        _written(tags), lambda p: F.struct(_name(p).alias("tag"), _value(p).alias("value"))
    )
    return F.when(F.length(tags) > 0, pairs)


def repeated(names: Column) -> Column:
    """Distinct values of an array that occur more than once."""
    several = F.filter(names, lambda n: F.size(F.filter(names, lambda m: m == n)) > 1)
    return F.when(
        F.size(names) > F.size(F.array_distinct(names)), F.array_distinct(several)
    ).otherwise(F.array().cast("array<string>"))


def tags_to_map(tags: Column) -> Column:
    """The tags as a map; null where a tag is repeated, since a map cannot hold it."""
    names = F.transform(_written(tags), _name)
    unique = F.size(names) == F.size(F.array_distinct(names))
    return F.when((F.length(tags) > 0) & unique, F.str_to_map(tags, F.lit("&"), F.lit("=")))
