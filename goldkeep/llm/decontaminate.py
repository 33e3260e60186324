"""Benchmark passages inside documents.

Every item is cut into windows of consecutive words. A window occurs in a document only if
all its shingles do, so it is enough to look for one of them, and the rarest over the whole
corpus is the one that brings up the fewest candidates. The join runs in two passes:

1. count in all documents how often each shingle of the benchmark occurs;
2. look up the rarest shingle of each window in every document. The place of the shingle
   inside the window says where the window would begin (positional bound) and its number of
   words whether it fits into the document (length bound). What is left is compared word by
   word, byte by byte.

Documents are not shuffled. The benchmark goes to the tasks in blocks of at most
``BLOCK_BYTES``, however large it is; documents stream through one task function per block.

Results for unusual input: null or empty texts have no words and no hits, as documents and as
items; an item without id marks words but is not listed; repeated items count once; repeated
documents are judged one by one; an empty table on either side means no hits; columns of the
documents named like a result column are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.llm.words import (
    NOT_ALPHANUMERIC,
    Words,
    equal_bytes,
    gram_hashes,
    gram_places,
    lists,
    runs,
    slices,
    split,
    word_hashes,
)
from goldkeep.shared import settle

#: Words of a window, and of a shingle.
WINDOW, SHINGLE = 10, 3
#: Most bytes of windows that are sent to the tasks at once.
BLOCK_BYTES = 32 << 20

_MASK = np.uint64((1 << 20) - 1)
_WINDOWS = "item string, window string, length int, shingles array<long>"


def _cut_items(window: int, shingle: int):
    """Task function: items in, one row per window out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = split(batch.column(1), NOT_ALPHANUMERIC, lower=True)
            hashes, spelled = word_hashes(words), words.strings().to_pylist()
            names = batch.column(0).to_pylist()
            out = [[], [], [], []]
            for item, low, high in zip(names, words.first[:-1], words.first[1:]):
                for start in range(low, max(high - window, low) + 1 if high > low else low):
                    stop = min(start + window, high)
                    grams = gram_hashes(hashes[start:stop], min(shingle, stop - start))
                    row = item, " ".join(spelled[start:stop]), stop - start, grams.view(np.int64)
                    for column, value in zip(out, row):
                        column.append(value)
            types = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "window", "length", "shingles"])

    return cut


class _Lookup:
    """Places of 64-bit keys in a sorted table, with a bit map before the search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.seen = np.zeros(int(_MASK) + 1, bool)
        self.seen[keys & _MASK] = True

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of ``values`` that are keys, and their first place in the table."""
        at = np.flatnonzero(self.seen[values & _MASK])
        if not len(at):
            return at, at
        place = np.searchsorted(self.keys, values[at])
        found = place < len(self.keys)
        found[found] = self.keys[place[found]] == values[at[found]]
        return at[found], place[found]


def _grams(words: Words, hashes: np.ndarray, lengths: list[int]):
    for n in lengths:
        places = gram_places(words.first, n)
        yield places, gram_hashes(hashes, n)[places] if len(places) else np.zeros(0, np.uint64)


def _count(keys, lengths: list[int]):
    """Task function: documents in, how often each key shingle occurs out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Lookup(keys.value)
        total = np.zeros(len(lookup.keys), np.int64)
        for batch in slices(batches):
            words = split(batch.column(0), NOT_ALPHANUMERIC, lower=True)
            for _, grams in _grams(words, word_hashes(words), lengths):
                total += np.bincount(lookup(grams)[1], minlength=len(total))
        at = np.flatnonzero(total)
        columns = [pa.array(lookup.keys[at].view(np.int64)), pa.array(total[at])]
        yield pa.RecordBatch.from_arrays(columns, ["shingle", "n"])

    return count


class _Block:
    """A block of windows, ordered by their rarest shingle."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["rarest"] % (1 << 64))
        self.items = [r["item"] for r in rows]
        self.length = np.array([r["length"] for r in rows], np.int64)
        self.place = np.array([r["place"] for r in rows], np.int64)
        self.key = np.array([r["rarest"] for r in rows], np.int64).view(np.uint64)
        spelled = pa.array([r["window"] for r in rows], pa.string())
        self.words = split(spelled, NOT_ALPHANUMERIC, lower=True)
        self.hashes = word_hashes(self.words)
        self.lengths = sorted({int(r["shingle"]) for r in rows})

    def find(self, words: Words, hashes: np.ndarray, lookup: _Lookup):
        """Word numbers at which windows occur, and which windows they are."""
        starts, windows = [], []
        text_of = words.text_of()
        for places, grams in _grams(words, hashes, self.lengths):
            at, low = lookup(grams)
            high = np.searchsorted(self.key, self.key[low], "right")
            window = runs(low, high - low)
            at = np.repeat(places[at], high - low)
            start = at - self.place[window]
            # positional and length bound: the window has to lie inside the document
            text = text_of[at]
            fits = (start >= words.first[text]) & (
                start + self.length[window] <= words.first[text + 1]
            )
            starts.append(start[fits])
            windows.append(window[fits])
        start = np.concatenate([np.zeros(0, np.int64), *starts])
        window = np.concatenate([np.zeros(0, np.int64), *windows])
        for same in (self._same_hash, self._same_bytes):
            n = self.length[window]
            equal = same(words, hashes, runs(start, n), runs(self.words.first[window], n))
            whole = np.add.reduceat(~equal, np.cumsum(n) - n, dtype=np.int64) == 0 if len(n) else n > 0
            start, window = start[whole], window[whole]
        return start, window

    def _same_hash(self, words, hashes, mine, own):
        return hashes[mine] == self.hashes[own]

    def _same_bytes(self, words, hashes, mine, own):
        own_words = self.words
        return equal_bytes(
            words.data, words.starts[mine], words.ends[mine],
            own_words.data, own_words.starts[own], own_words.ends[own],
        )


ADDED = {"n_words": "bigint", "hit_words": "array<int>", "found_items": "array<string>"}


def _mark(block, names: list[str], text: int):
    """Task function: documents in, the same with the hits of ``block`` added to those that
    blocks before it have found."""
    carried = [n for n in names if n not in ADDED]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        lookup = _Lookup(own.key)
        item_of = pa.array(own.items, pa.string())
        for batch in slices(batches):
            words = split(batch.column(text), NOT_ALPHANUMERIC, lower=True)
            start, window = own.find(words, word_hashes(words), lookup)
            edge = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + own.length[window], -1)
            hit = np.cumsum(edge[:-1]) > 0
            texts = words.text_of()
            item, item_text = item_of.take(pa.array(window)), texts[start]
            if "hit_words" in names:
                at, value = _listed(batch.column(names.index("hit_words")))
                hit[words.first[at] + value.to_numpy()] = True
                at, value = _listed(batch.column(names.index("found_items")))
                item = pa.concat_arrays([item, value.cast(pa.string())])
                item_text = np.concatenate([item_text, at])
            hit = np.flatnonzero(hit)
            pairs = pa.table({"text": item_text, "item": item}).filter(pc.is_valid(item))
            pairs = pairs.group_by(["text", "item"]).aggregate([]).sort_by("text")
            place = (hit - words.first[texts[hit]]).astype(np.int32)
            added = [
                pa.array(words.counts),
                lists(pa.array(place), np.bincount(texts[hit], minlength=batch.num_rows)),
                lists(
                    pairs["item"].combine_chunks(),
                    np.bincount(pairs["text"].to_numpy(), minlength=batch.num_rows),
                ),
            ]
            columns = [batch.column(names.index(n)) for n in carried] + added
            yield pa.RecordBatch.from_arrays(columns, [*carried, *ADDED])

    return mark


def _listed(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Text numbers and values of a list column."""
    return np.repeat(np.arange(len(column)), column.value_lengths().to_numpy()), column.flatten()


def windows_of(items: DataFrame, id_column: str, text_column: str, window: int, shingle: int):
    """One row per window of every item: item, window, length in words, shingles."""
    chosen = items.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(_cut_items(window, shingle), _WINDOWS).distinct()


def _blocks(windows: DataFrame) -> tuple[DataFrame, int]:
    """``windows`` with a block number, and how many blocks of bounded bytes there are."""
    weight = F.sum(F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + 120)
    count = 1 + (windows.agg(weight).first()[0] or 0) // BLOCK_BYTES
    return windows.withColumn("block", F.pmod(F.xxhash64("item", "window"), F.lit(count))), count


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_column: str = "item_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_words`` (numbers of the words that lie inside an
    occurring window) and ``found_items`` (ids of the items it belongs to, as strings)."""
    spark = docs.sparkSession
    windows, count = _blocks(settle(windows_of(items, id_column, text_column, window, shingle)))

    texts = docs.select(text_column)
    counted = []
    length = F.least("length", F.lit(shingle)).alias("shingle")
    for block in range(count):
        own = windows.where(F.col("block") == block)
        keys = own.select(length, F.explode("shingles").alias("key")).distinct().collect()
        table = np.array([k["key"] for k in keys], np.int64).view(np.uint64)
        lengths = sorted({k["shingle"] for k in keys})
        sent = spark.sparkContext.broadcast(np.unique(table))
        counted.append(texts.mapInArrow(_count(sent, lengths), "shingle long, n long"))
    occurrences = counted[0]
    for more in counted[1:]:
        occurrences = occurrences.unionByName(more)
    occurrences = occurrences.groupBy("shingle").agg(F.sum("n").alias("n"))
    placed = windows.select("*", F.posexplode("shingles").alias("place", "key"))
    ranked = (
        placed.join(occurrences, placed["key"] == occurrences["shingle"], "left")
        .groupBy("block", "item", "window", "length")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "key")).alias("first"))
        # a window with a shingle that occurs nowhere cannot occur
        .where("first.n > 0")
        .select("block", "item", "window", "length", length, "first.place", F.col("first.key").alias("rarest"))
    )
    ranked = settle(ranked)

    result = docs.select(*[c for c in docs.columns if c not in ADDED])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in result.schema.fields]
    schema = ", ".join([*fields, *(f"{name} {kind}" for name, kind in ADDED.items())])
    for block in range(count):
        sent = spark.sparkContext.broadcast(_Block(ranked.where(F.col("block") == block).collect()))
        names = result.columns
        result = result.mapInArrow(_mark(sent, names, names.index(text_column)), schema)
    return result
