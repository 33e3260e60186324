"""Words of whole text columns as arrays: bounds, hashes and exact comparison.

All functions work on the UTF-8 bytes of a whole Arrow batch at once. A word never spans two
texts. Hashes are 64 bits; whoever needs exactness compares the bytes afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once; keeps the temporary arrays small whatever the texts' length.
BLOCK = 1 << 20
#: Rows that a task works on at once.
SLICE = 1000


def delimiters(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes that separate words, from inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Everything in ASCII but digits and lower-case letters.
NOT_ALPHANUMERIC = delimiters((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
#: ASCII white space.
WHITE_SPACE = delimiters((0x20, 0x20), (0x09, 0x0D))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [_powers(_BASE, n), _powers(inverse, n)]
    return _POWERS


@dataclass
class Words:
    """Words of a batch: ``data[starts[i]:ends[i]]`` is word i, text t owns the words
    ``first[t]`` up to ``first[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Text number of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def strings(self) -> pa.Array:
        """The words as one Arrow array."""
        return strings(self.data, self.starts, self.ends)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that a task's arrays stay small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and where each text begins, the end of the last included.
    A null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(column: pa.Array, separators: np.ndarray, lower: bool = False) -> Words:
    """Words between ``separators``; ``lower`` maps A-Z to a-z first."""
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return Words(data, empty, empty, np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < n]
    begins[at] = inside[at]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    finishes[last] = inside[last]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets))


def word_hashes(words: Words) -> np.ndarray:
    """64-bit hash of every word, the same in every batch."""
    out = np.empty(len(words.starts), np.uint64)
    i = 0
    while i < len(out):
        low = words.starts[i]
        j = max(i + 1, int(np.searchsorted(words.ends, low + BLOCK, "right")))
        size = int(words.ends[j - 1] - low)
        power, inverse = _power_tables(max(size, BLOCK) + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_CODES[words.data[low : low + size]] * power[:size], out=sums[1:])
        start = words.starts[i:j] - low
        out[i:j] = (sums[words.ends[i:j] - low] - sums[start]) * inverse[start]
        i = j
    return mix(out)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of ``n`` consecutive values from every place, whatever text they belong to."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, n, np.uint64)
    for i in range(n):
        total *= np.uint64(0xD6E8FEB86659FD93)
        total += hashes[i : i + count]
    return mix(total)


def gram_places(first: np.ndarray, n: int) -> np.ndarray:
    """Words at which a run of ``n`` words of one text begins."""
    return runs(first[:-1], np.maximum(np.diff(first) - n + 1, 0))


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` of ``lengths[i]`` numbers each, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def equal_bytes(a, a_start, a_end, b, b_start, b_end) -> np.ndarray:
    """Whether slice i of ``a`` equals slice i of ``b``, byte by byte."""
    length = a_end - a_start
    same = length == b_end - b_start
    at = np.flatnonzero(same & (length > 0))
    step = max(1, BLOCK // max(1, int(length[at].max(initial=1))))
    for i in range(0, len(at), step):
        part = at[i : i + step]
        n = length[part]
        unequal = a[runs(a_start[part], n)] != b[runs(b_start[part], n)]
        same[part] = np.add.reduceat(unequal, np.cumsum(n) - n, dtype=np.int64) == 0
    return same


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of UTF-8 bytes as an Arrow text array."""
    length = ends - starts
    offsets = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    values = np.ascontiguousarray(data[runs(starts, length)])
    return pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(values))


def lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    """Consecutive groups of ``values`` as an Arrow list array."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
