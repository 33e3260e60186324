"""Referential checks with a Bloom filter of one side's keys before the shuffle.

The filter is an array of bits built by a grouped aggregate and sized from the number of keys.
A key whose bits are not all set is surely in no record of that side: it is an orphan, or of no
use to the other side, without a join. Only keys that may be present go into the anti-join,
which decides them exactly; a filter that is too full costs time, never a result. Key sets
that would need more than ``FILTER_BYTES`` are joined without a filter.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldkeep.shared import settle

#: Largest filter, which every task gets.
FILTER_BYTES = 16 << 20
#: Bits for each key and hash functions: about one key in a hundred passes by chance.
BITS, HASHES = 10, 7


class KeyFilter(NamedTuple):
    """``words`` is a scalar array of 64-bit words; keys are compared as ``key_type``."""

    words: Column
    bits: int
    key_type: str

    def may_hold(self, key: Column) -> Column:
        """False for keys that are surely absent, nulls among them."""
        found = [
            F.element_at(self.words, _word(p)).bitwiseAND(_bit(p)) != 0
            for p in _places(key.cast(self.key_type), self.bits)
        ]
        every = found[0]
        for one in found[1:]:
            every = every & one
        return F.coalesce(key.isNotNull() & every, F.lit(False))


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _word(place: Column) -> Column:
    return (F.shiftright(place, 6) + 1).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))


def key_filter(master: DataFrame, column: str = "id") -> KeyFilter | None:
    """The filter of a key column, or nothing where it would be too large."""
    spark, kind = master.sparkSession, master.schema[column].dataType.simpleString()
    keys = master.select(F.col(column).alias("id")).where("id is not null")
    words = max(1, -(-keys.count() * BITS // 64))
    if 8 * words > FILTER_BYTES:
        return None
    places = keys.select(F.explode(F.array(*_places(F.col("id"), 64 * words))).alias("place"))
    set_bits = places.groupBy(_word(F.col("place")).alias("word")).agg(F.bit_or(_bit(F.col("place"))).alias("bits"))
    every = spark.range(1, words + 1).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits"))
    dense = set_bits.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    one = settle(dense.agg(F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"].alias("words")))
    return KeyFilter(one.scalar(), 64 * words, kind)


def orphans(facts: DataFrame, master: DataFrame) -> DataFrame:
    """Keys ``id`` of the fact key set without a master record; a null key is one."""
    known = key_filter(master)
    if known is None:
        return facts.join(master, "id", "left_anti")
    maybe = known.may_hold(F.col("id"))
    surely = facts.where(~maybe)
    return surely.unionByName(facts.where(maybe).join(master, "id", "left_anti"))


def unused(facts: DataFrame, master: DataFrame) -> DataFrame:
    """Keys of the master key set no fact refers to. Facts may repeat keys: those that no master
    record can have stay out of the join."""
    known = key_filter(master)
    used = facts if known is None else facts.where(known.may_hold(F.col("id")))
    return master.join(used.distinct(), "id", "left_anti")


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys absent from the parent, with the number of child rows."""
    keys = parent.select(F.col(parent_key).alias("id"))
    known = key_filter(keys)
    rows = child.where(F.col(column).isNotNull()).select(F.col(column).alias("id"))
    counted = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"))
    if known is None:
        return counted.join(keys, "id", "left_anti")
    # one count; the split comes after it, so the rows are shuffled once
    counted = settle(counted)
    maybe = known.may_hold(F.col("id"))
    return counted.where(~maybe).unionByName(counted.where(maybe).join(keys, "id", "left_anti"))
