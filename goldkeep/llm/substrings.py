"""Word sequences that an earlier document holds, removed wherever they come again.

A window is ``window`` consecutive words. Its minimiser is the smallest hash among the short
word n-grams it contains. Consecutive windows with one minimiser overlap in all words but a
few, so they travel as one string, a super-k-mer, to the bucket of the minimiser. Equal windows
have equal minimisers and meet in one bucket, which sorts its windows, compares equal ones
word by word and knows the smallest document of each.

A minimiser that stands for a large share of all super-k-mers, as a frequent phrase with many
surroundings does, is heavy. A window under a heavy minimiser goes by the hash of all its words
instead, which equal windows share as well, so such windows spread over all buckets. Heavy
minimisers are found beforehand in one pass over the texts; there are at most
``2 * SPREAD * MOST_SPREAD`` of them.

1. Documents are dealt into chunks of bounded size. A chunk sends each distinct super-k-mer
   once per bucket, with the smallest and largest document that has it, so a passage that
   everybody copies reaches its bucket once per chunk.
2. A bucket answers each chunk with the runs of windows of its super-k-mers that begin in a
   smaller document.
3. The chunk, still laid out as in step 1, lays the answers over its documents.

Results for unusual input: a null text has no words; a text of fewer words than a window loses
none; a null id counts as larger than all others; rows of one id are judged one by one and do
not remove each other's words; an empty table gives no rows; columns named like a result column
are replaced, all others are kept. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.llm.blobs import group_of, groups_for, pack, text_size, unpack
from goldkeep.llm.words import (
    WHITE_SPACE,
    Words,
    gram_hashes,
    gram_places,
    mix,
    runs,
    slices,
    split,
    word_hashes,
)
from goldkeep.shared import settle

WINDOW, MINIMISER = 13, 3
#: Bytes of text that one chunk or one bucket holds, about.
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20

#: A minimiser is heavy from one part in ``SPREAD`` of a bucket's share on; shares of buckets are
#: taken as if there were no more than ``MOST_SPREAD``.
SPREAD, MOST_SPREAD = 4, 100_000

NO_ID = np.iinfo(np.int64).max
ADDED = {"n_words": "bigint", "n_removed": "bigint", "kept_text": "string"}


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``width`` consecutive values, from every place."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _super_kmer_runs(words: Words, window: int, minimiser: int, heavy: np.ndarray):
    """First word, number of windows and key of all super-k-mers. The key is the minimiser, or
    the hash of the whole window where that is ``heavy`` (in order)."""
    minimiser = min(minimiser, window)
    places = gram_places(words.first, window)
    least = np.zeros(0, np.uint64)
    if len(places):
        hashes = word_hashes(words)
        least = _sliding_min(gram_hashes(hashes, minimiser), window - minimiser + 1)[places]
        if len(heavy):
            at = np.flatnonzero(heavy[np.searchsorted(heavy[:-1], least)] == least)
            least[at] = gram_hashes(hashes, window)[places[at]]
    new = np.ones(len(places), bool)
    new[1:] = (least[1:] != least[:-1]) | (np.diff(places) != 1)
    first = np.flatnonzero(new)
    return places[first], np.diff(first, append=len(places)), least[first]


class _SuperKmers:
    """Super-k-mers of a chunk: occurrence i begins at word ``start[i]`` of row ``row[i]``,
    covers ``windows[i]`` windows and spells ``distinct[which[i]]``."""

    def __init__(self, words: Words, window: int, minimiser: int, heavy: np.ndarray):
        self.start, self.windows, key = _super_kmer_runs(words, window, minimiser, heavy)
        self.row = words.text_of()[self.start]
        last = self.start + self.windows + window - 2
        raw = words.data.tobytes()
        begins, ends = words.starts[self.start].tolist(), words.ends[last].tolist()
        spelled = pa.array([raw[a:b] for a, b in zip(begins, ends)], pa.large_binary())
        coded = spelled.dictionary_encode()
        self.distinct = coded.dictionary
        self.which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.key = np.zeros(len(self.distinct), np.uint64)
        self.key[self.which] = key


def _count_minimisers(window: int, minimiser: int, least: float):
    """Texts in; minimisers with at least this share of the bytes of a batch's different
    super-k-mers, added up, and all such bytes (no minimiser), out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = split(batch.column(0), WHITE_SPACE)
            start, windows, key = _super_kmer_runs(words, window, minimiser, np.zeros(0, np.uint64))
            if not len(start):
                continue
            # a super-k-mer is named by its first window and its length, well enough to count
            name = gram_hashes(word_hashes(words), window)[start] + mix(windows.astype(np.uint64))
            one = np.unique(name, return_index=True)[1]
            size = words.ends[start + windows + window - 2] - words.starts[start]
            keys, place = np.unique(key[one], return_inverse=True)
            total = np.bincount(place, size[one]).astype(np.int64)
            often = total >= least * total.sum()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*keys[often].view(np.int64).tolist(), None], pa.int64()),
                    pa.array(np.append(total[often], total.sum())),
                ],
                ["key", "n"],
            )

    return count


def heavy_minimisers(texts: DataFrame, window: int, minimiser: int, buckets: int) -> np.ndarray:
    """Hashes, in order, of the minimisers with a large share of all super-k-mers."""
    shares = SPREAD * min(buckets, MOST_SPREAD)
    # counting leaves out less than one part in 2 * shares, so none above 1 / shares is missed
    counted = texts.mapInArrow(
        _count_minimisers(window, minimiser, 1 / (2 * shares)), "key long, n long"
    )
    counted = settle(counted.groupBy("key").agg(F.sum("n").alias("n")))
    total = counted.where("key is null").agg(F.max("n")).first()[0] or 0
    found = counted.where(F.col("key").isNotNull() & (F.col("n") * (2 * shares) >= total)).collect()
    return np.sort(np.array([r["key"] for r in found], np.int64).view(np.uint64))


def _chunk_rows(table: pa.Table, id_column: str, text_column: str):
    """Rows of a chunk in an order that depends on nothing but the rows, with ids and words."""
    order = pc.sort_indices(
        table.select([id_column, "_digest"]),
        [(id_column, "ascending"), ("_digest", "ascending")],
    )
    table = table.take(order)
    ids = pc.fill_null(table[id_column].cast(pa.int64()), int(NO_ID)).to_numpy()
    text = table[text_column].cast(pa.large_string()).combine_chunks()
    return table, ids, split(text, WHITE_SPACE)


def _send(id_column: str, text_column: str, window: int, minimiser: int, buckets: int, heavy):
    """Chunk in, one row per bucket with its distinct super-k-mers out."""

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, ids, words = _chunk_rows(table, id_column, text_column)
        found = _SuperKmers(words, window, minimiser, heavy.value)
        count = len(found.distinct)
        low, high = np.full(count, NO_ID), np.full(count, np.iinfo(np.int64).min)
        np.minimum.at(low, found.which, ids[found.row])
        np.maximum.at(high, found.which, ids[found.row])
        bucket = (mix(found.key) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        all_rows = pa.table(
            {
                "text": found.distinct.take(pa.array(order)),
                "index": order.astype(np.int32),
                "low": low[order],
                "high": high[order],
            }
        )
        used, first = np.unique(bucket[order], return_index=True)
        ends = np.append(first[1:], count)
        blobs = [pack(all_rows.slice(a, b - a)) for a, b in zip(first.tolist(), ends.tolist())]
        chunk = np.full(len(used), key[0].as_py(), np.int32)
        return pa.table(
            {"_bucket": used.astype(np.int32), "_chunk": chunk, "blob": pa.array(blobs, pa.binary())}
        )

    return send


def _window_groups(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all windows and a number that equal windows share, told apart word by word."""
    places = gram_places(words.first, window)
    if not len(places):
        return places, places
    spelled = words.strings().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    hashes = gram_hashes(word_hashes(words), window)[places]
    order = np.argsort(hashes, kind="stable")
    hashes, at = hashes[order], places[order]
    alike = np.flatnonzero(hashes[1:] == hashes[:-1])
    same = np.ones(len(alike), bool)
    for i in range(window):
        same &= spelled[at[alike] + i] == spelled[at[alike + 1] + i]
    if not same.all():  # windows that differ share a hash: sort by the words themselves
        order = np.lexsort([spelled[places + i] for i in reversed(range(window))])
        at = places[order]
        equal = np.ones(len(at) - 1, bool)
        for i in range(window):
            equal &= spelled[at[1:] + i] == spelled[at[:-1] + i]
    else:
        equal = hashes[1:] == hashes[:-1]
    group = np.empty(len(places), np.int64)
    group[order] = np.concatenate([[0], np.cumsum(~equal)])
    return places, group


def _answer(window: int):
    """All super-k-mers of a bucket in; runs of windows with an earlier document out."""

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks = table["_chunk"].to_numpy()
        parts = [unpack(b) for b in table["blob"].to_pylist()]
        sent = pa.concat_tables(parts)
        chunk = np.repeat(chunks, [p.num_rows for p in parts])
        words = split(_joined(sent["text"]).view(pa.large_string()), WHITE_SPACE)
        low, high = sent["low"].to_numpy(), sent["high"].to_numpy()
        places, group = _window_groups(words, window)
        text = words.text_of()[places]
        least = np.full(int(group.max(initial=-1)) + 1, NO_ID)
        np.minimum.at(least, group, low[text])
        earliest = least[group]
        at = np.flatnonzero(earliest < high[text])
        # neighbouring windows with one earliest document form a run
        text, place, earliest = text[at], places[at], earliest[at]
        new = np.ones(len(at), bool)
        new[1:] = (
            (text[1:] != text[:-1]) | (np.diff(place) != 1) | (earliest[1:] != earliest[:-1])
        )
        first = np.flatnonzero(new)
        length = np.diff(first, append=len(at))
        text, begin = text[first], place[first] - words.first[text[first]]
        answers = pa.table(
            {
                "index": sent["index"].to_numpy()[text],
                "begin": begin.astype(np.int32),
                "windows": length.astype(np.int32),
                "earliest": earliest[first],
            }
        )
        to = chunk[text]
        used, start = np.unique(to, return_index=True)
        order = np.argsort(start)
        used, start = used[order], start[order]
        ends = np.append(start[1:], len(to))
        blobs = [pack(answers.slice(a, b - a)) for a, b in zip(start.tolist(), ends.tolist())]
        return pa.table({"_chunk": used.astype(np.int32), "blob": pa.array(blobs, pa.binary())})

    return answer


def _joined(column: pa.ChunkedArray) -> pa.Array:
    joined = column.combine_chunks()
    return pa.concat_arrays(joined.chunks) if isinstance(joined, pa.ChunkedArray) else joined


_NO_RUNS = pa.table(
    {
        "index": pa.array([], pa.int32()),
        "begin": pa.array([], pa.int32()),
        "windows": pa.array([], pa.int32()),
        "earliest": pa.array([], pa.int64()),
    }
)


def _remove(
    names: list[str], id_column: str, text_column: str, window: int, minimiser: int, heavy
):
    """A chunk and its answers in, its documents without the repeated words out."""

    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows, ids, words = _chunk_rows(docs, id_column, text_column)
        found = _SuperKmers(words, window, minimiser, heavy.value)
        told = pa.concat_tables([_NO_RUNS, *(unpack(b) for b in answers["blob"].to_pylist())])
        told = told.sort_by("index")
        index = told["index"].to_numpy()
        low = np.searchsorted(index, found.which, "left")
        count = np.searchsorted(index, found.which, "right") - low
        run = runs(low, count)
        of = np.repeat(np.arange(len(count)), count)
        kept = told["earliest"].to_numpy()[run] < ids[found.row[of]]
        run, of = run[kept], of[kept]
        begin = found.start[of] + told["begin"].to_numpy()[run]
        edge = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + told["windows"].to_numpy()[run] + window - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        left = np.flatnonzero(~gone)
        rows_of = words.text_of()
        removed = np.bincount(rows_of[gone], minlength=rows.num_rows)
        raw = words.data.tobytes()
        spelled = [
            raw[a:b] for a, b in zip(words.starts[left].tolist(), words.ends[left].tolist())
        ]
        stops = np.cumsum(words.counts - removed)
        texts = [
            b" ".join(spelled[a:b]).decode()
            for a, b in zip((stops - words.counts + removed).tolist(), stops.tolist())
        ]
        added = [pa.array(words.counts), pa.array(removed), pa.array(texts, pa.string())]
        return pa.table([rows[n] for n in names] + added, names=[*names, *ADDED])

    return remove


def drop_repeated_substrings(
    docs: DataFrame,
    window: int = WINDOW,
    minimiser: int = MINIMISER,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, the words that stay joined
    by single blanks. A word goes if it lies in a window that also begins in a document with
    a smaller id."""
    names = [c for c in docs.columns if c not in ADDED]
    # numbered inside, so no name of the table can be one of those used here
    inside = {c: f"c{i}" for i, c in enumerate(names)}
    kept = docs.select(*[F.col(f"`{c}`").alias(inside[c]) for c in names])
    id_column, text_column = inside[id_column], inside[text_column]
    size = text_size(kept, text_column)
    chunks = groups_for(size, CHUNK_BYTES)
    # a word is in about three super-k-mers
    buckets = groups_for(3 * size, BUCKET_BYTES)
    heavy = docs.sparkSession.sparkContext.broadcast(
        heavy_minimisers(kept.select(text_column), window, minimiser, buckets)
    )
    dealt = kept.withColumn("_digest", F.xxhash64(text_column)).withColumn(
        "_chunk", group_of(chunks, id_column, "_digest")
    )
    # laid out once; both passes over the chunks read this exchange
    dealt = dealt.repartition("_chunk")
    sent = dealt.groupBy("_chunk").applyInArrow(
        _send(id_column, text_column, window, minimiser, buckets, heavy),
        "_bucket int, _chunk int, blob binary",
    )
    answers = sent.groupBy("_bucket").applyInArrow(_answer(window), "_chunk int, blob binary")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    schema = ", ".join([*fields, *(f"{name} {kind}" for name, kind in ADDED.items())])
    remove = _remove(kept.columns, id_column, text_column, window, minimiser, heavy)
    found = dealt.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(remove, schema)
    return found.toDF(*names, *ADDED)
