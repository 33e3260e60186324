"""Packing token sequences into fixed windows with little padding.

Each partition packs its documents online and keeps a fixed number of windows open. A document
is cut into whole windows, which are full at once, and a rest. The rest goes to the open
window it fits best; when it fits none, the fullest window is emitted and a new one opened.
The windows open at the end are the leftovers. Leftovers of several partitions are merged by
filling windows one after another, cutting where a window ends, so only the last window of
each merge is padded.

Results for unusual input: a null or empty text is the end token alone; a null id is kept;
repeated rows are packed as often as they occur; an empty table gives no rows; columns of the
input other than id and text are ignored. A sequence never holds more than ``window`` tokens.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.llm.words import runs
from goldkeep.shared import scratch_path

#: Windows that one partition keeps open.
OPEN_WINDOWS = 64
#: Partitions whose leftovers are merged together.
MERGED_PARTITIONS = 16
#: Documents tokenized at once.
SLICE = 2000
#: Words whose ids a worker remembers before it starts anew; bounds its memory.
REMEMBERED_WORDS = 1_000_000

# How a tokenizer file says that case makes no difference, and that white space
# separates words and is dropped.
BY_WORD = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "replaced": [r"\s+", " "],
    "split": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "behavior": ["Removed", True],
}


def splits_words(file: str) -> bool:
    """Whether the ids of a text by the tokenizer ``file`` surely are those of its words."""
    with open(file, encoding="utf-8") as held:
        own = json.load(held)
    steps = (own["normalizer"] or {}).get("normalizers", [])
    first = ((own["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    replaced = [(s["pattern"].get("Regex"), s["content"]) for s in steps if s["type"] == "Replace"]
    said = {
        "normalizer": [s["type"] for s in steps],
        "replaced": list(replaced[0]) if replaced else None,
        "split": first.get("pattern", {}).get("Regex"),
        "behavior": [first.get("behavior"), first.get("invert")],
    }
    stripping = any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in own["added_tokens"])
    return said == BY_WORD and not stripping and not own["model"].get("dropout")


def _flat(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), lengths


class WordTokenizer:
    """Ids of whole texts, as a plain call without added special tokens gives them.

    Where the tokenizer's file shows that it drops white space and never joins across it
    (:func:`splits_words`), each distinct word is encoded once per worker process and
    remembered, many words at a time with a mark of the tokenizer ``between`` them. Other
    tokenizers encode whole texts. A mark spelt in a text gives the mark's id, as in the plain
    call; with ``literal_marks`` it is ordinary text.
    """

    def __init__(
        self, file: str, end: int, between: str = "<|endoftext|>", literal_marks: bool = False
    ):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.tokenizer = Tokenizer.from_file(file)
        self.between = between
        self.mark = self.tokenizer.token_to_id(between)
        self.plain = Tokenizer.from_file(file)
        self.plain.encode_special_tokens = literal_marks
        self.marks = [t.content.lower() for t in self.plain.get_added_tokens_decoder().values()]
        # most words are told apart by what all marks begin with
        self.mark_head = os.path.commonprefix(self.marks)
        self.by_word = splits_words(file) and self.mark is not None
        self.end = end
        self.forget()

    def _has_mark(self, word: str) -> bool:
        lower = word.lower()
        return self.mark_head in lower and any(m in lower for m in self.marks)

    def _stem(self, word: str) -> tuple[str, str]:
        """``word`` without what does not change its ids, and the mark to be put after it."""
        if self._has_mark(word):
            return word, ""
        if word[-1:] in (".", ",") and word[-2:-1].isascii() and word[-2:-1].isalpha():
            word, mark = word[:-1], word[-1]
        else:
            mark = ""
        return (word.lower() if word.isascii() else word), mark

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        """Remember the ids of new ``words``. Case in ASCII makes no difference to the
        tokenizer, nor does a full stop or comma after a letter to what stands before it, so
        spellings that differ in these share one encoding."""
        stems = [self._stem(word) for word in words]
        new = {s for s, _ in stems if s not in self.place} | {
            m for _, m in stems if m and m not in self.place
        }
        marked = [s for s in new if self._has_mark(s)]
        self._encode(list(new.difference(marked)), self.tokenizer, 50)
        self._encode(marked, self.plain, 1)
        rest = [(w, s, m) for w, (s, m) in zip(words, stems) if w not in self.place]
        whole = np.fromiter((self.place[s] for _, s, _ in rest), np.int64, len(rest))
        tail = np.fromiter((self.place[m] if m else -1 for _, _, m in rest), np.int64, len(rest))
        both = np.stack([whole, tail], 1).ravel()
        both, each = both[both >= 0], 1 + (tail >= 0)
        length = self.starts[both + 1] - self.starts[both]
        ids = self.ids[runs(self.starts[both], length)]
        first = np.cumsum(each) - each
        self._store([w for w, _, _ in rest], ids, np.add.reduceat(length, first) if rest else first)

    def _encode(self, words: list[str], tokenizer, together: int) -> None:
        joined = [self.between.join(words[i : i + together]) for i in range(0, len(words), together)]
        encoded = tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        parts = [np.array(e.ids, np.int64) for e in encoded]
        if together == 1:
            return self._store(words, *_flat(parts))
        closed = [np.append(p, self.mark) for p in parts]
        ids = np.concatenate(closed) if closed else np.zeros(0, np.int64)
        at = np.flatnonzero(ids == self.mark)
        return self._store(words, np.delete(ids, at), np.diff(at, prepend=-1) - 1)

    def _store(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another and each closed by the end token, and how many
        each text has."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            encoded = self.plain.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            parts = [np.array([*e.ids, self.end], np.uint32) for e in encoded]
            ids, counts = _flat(parts)
            return ids.astype(np.uint32), counts
        for blank in "\n\r\t":
            texts = pc.replace_substring(texts, blank, " ")
        words = pc.split_pattern(texts, " ")
        first = words.offsets.to_numpy()
        coded = words.flatten().dictionary_encode()
        known = coded.dictionary.to_pylist()
        new = [w for w in known if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED_WORDS:
            self.forget()
            new = known
        if new:
            self.learn(new)
        slot = np.fromiter((self.place[w] for w in known), np.int64, len(known))
        word = slot[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else slot
        length = self.starts[word + 1] - self.starts[word]
        before = np.zeros(len(word) + 1, np.int64)
        np.cumsum(length, out=before[1:])
        first = first - first[0]
        counts = before[first[1:]] - before[first[:-1]] + 1
        out = np.full(int(counts.sum()), self.end, np.uint32)
        place = np.ones(len(out), bool)
        place[np.cumsum(counts) - 1] = False
        out[place] = self.ids[runs(self.starts[word], length)]
        return out, counts


@functools.lru_cache(maxsize=1)
def word_tokenizer(file: str, end: int) -> WordTokenizer:
    """The tokenizer of this worker process; what it has learnt serves later tasks as well."""
    return WordTokenizer(file, end)


SCHEMA = (
    "doc_id {id}, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, open boolean"
)


class _Emitted:
    """Pieces on their way out, as columns."""

    def __init__(self, id_type: pa.DataType):
        self.id_type = id_type
        self.columns: list[list] = [[] for _ in range(8)]
        self.bytes = 0

    def add(self, piece: tuple, sequence: int, offset: int, is_open: bool) -> None:
        doc, start, ids, doc_tokens = piece
        values = (doc, start, len(ids) // 4, ids, doc_tokens, sequence, offset, is_open)
        for column, value in zip(self.columns, values):
            column.append(value)
        self.bytes += len(ids)

    def sequence(self, pieces: list[tuple], sequence: int, is_open: bool = False) -> None:
        offset = 0
        for piece in pieces:
            self.add(piece, sequence, offset, is_open)
            offset += len(piece[2]) // 4

    def take(self) -> pa.RecordBatch:
        types = [self.id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.bool_()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "open"]
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(self.columns, types)], names=names
        )
        self.__init__(self.id_type)
        return batch


def _online(make_tokenizer: Callable, window: int, open_windows: int):
    """Task function: documents in, pieces out; windows still open at the end are marked."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = make_tokenizer()
        sequence = TaskContext.get().partitionId() << 40
        used = np.zeros(open_windows, np.int64)
        held: list[list[tuple]] = [[] for _ in range(open_windows)]
        out = None
        for batch in batches:
            out = out or _Emitted(batch.column(0).type)
            docs = batch.column(0).to_pylist()
            for first in range(0, len(docs), SLICE):
                ids, counts = tokenizer(batch.column(1).slice(first, SLICE))
                ends = np.cumsum(counts)
                raw = memoryview(ids.astype("<u4", copy=False).tobytes())
                for doc, begin, end in zip(docs[first:], (ends - counts).tolist(), ends.tolist()):
                    tokens, start = end - begin, 0
                    while tokens - start >= window:
                        piece = bytes(raw[4 * (begin + start) : 4 * (begin + start + window)])
                        out.sequence([(doc, start, piece, tokens)], sequence)
                        sequence += 1
                        start += window
                    rest = tokens - start
                    if not rest:
                        continue
                    piece = (doc, start, bytes(raw[4 * (begin + start) : 4 * end]), tokens)
                    fits = used + rest
                    fits[fits > window] = -1
                    best = int(fits.argmax())
                    if fits[best] < 0:
                        best = int(used.argmax())
                        out.sequence(held[best], sequence)
                        sequence += 1
                        held[best], used[best] = [], 0
                    held[best].append(piece)
                    used[best] += rest
                if out.bytes > 1 << 23:
                    yield out.take()
        for pieces in held:
            if pieces:
                out.sequence(pieces, sequence, is_open=True)
                sequence += 1
        if out is not None:
            yield out.take()

    return pack


def _merge(window: int, first_sequence: int):
    """Task function: leftover pieces of whole groups in, in order, full windows out; only the
    last of each group is not full. Sequences are numbered by the group, not by the task."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence, offset, out, last = 0, 0, None, None
        for batch in batches:
            out = out or _Emitted(batch.column(0).type)
            taken = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 8)]
            for doc, start, ids, doc_tokens, group in zip(*taken):
                if group != last:
                    sequence, offset, last = first_sequence + (group << 40), 0, group
                while ids:
                    if offset == window:
                        sequence, offset = sequence + 1, 0
                    part, ids = ids[: 4 * (window - offset)], ids[4 * (window - offset) :]
                    out.add((doc, start, part, doc_tokens), sequence, offset, False)
                    start += len(part) // 4
                    offset += len(part) // 4
            if out.bytes > 1 << 23:
                yield out.take()
        if out is not None:
            yield out.take()

    return merge


def pack(
    docs: DataFrame,
    make_tokenizer: Callable,
    window: int = 4096,
    open_windows: int = OPEN_WINDOWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents with the sequence and the offset each is placed at.

    ``make_tokenizer`` is called in every task and returns what maps an Arrow text array to
    ids and counts, as :class:`WordTokenizer` does. ``ids`` of the result holds the piece's
    ids as little-endian unsigned 32-bit integers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = SCHEMA.format(id=rows.schema["doc_id"].dataType.simpleString())
    path = scratch_path(spark, "packed")
    # tokenized once: both the finished windows and the leftovers are read from the table
    placed = rows.mapInArrow(_online(make_tokenizer, window, open_windows), schema)
    placed.write.option("compression", "zstd").parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    left = stored.where("open")
    # groups and the order in them follow from the stored rows, so every run gives one layout
    group = F.expr(f"shiftright(sequence_id, 40) div {MERGED_PARTITIONS}")
    grouped = left.withColumn("group", group)
    groups = (grouped.agg(F.max("group")).first()[0] or 0) + 1
    dealt = grouped.repartitionById(groups, F.col("group").cast("int"))
    dealt = dealt.sortWithinPartitions("group", "sequence_id", "offset")
    merged = dealt.mapInArrow(_merge(window, 1 << 62), schema)
    return stored.where("not open").unionByName(merged).drop("open")


def padding(pieces: DataFrame, window: int = 4096) -> DataFrame:
    """How many sequences there are, and how many places in them stay empty. A sequence whose
    length is a power of two is used as it is, every other one is filled up to ``window``."""
    lengths = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"))
    exact = F.expr("(length & (length - 1)) = 0")
    return lengths.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.sum(F.when(exact, 0).otherwise(window - F.col("length"))).alias("padding"),
        F.sum("length").alias("tokens"),
    )


def pack_words(
    docs: DataFrame, tokenizer_file: str, end: int, window: int = 4096, **options
) -> DataFrame:
    """:func:`pack` with a :class:`WordTokenizer` over ``tokenizer_file``, a file that every
    executor has at the same place."""
    return pack(docs, lambda: word_tokenizer(tokenizer_file, end), window, **options)
