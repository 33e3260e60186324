"""How two tokenizers cut the same texts: groups of tokens between common cuts, and links.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file), B a SentencePiece model. Every token of
either covers a run of bytes of a space and the text. Where a token of A and one of B end at one
byte, both cut there: the two tokens are linked, and the cuts divide the tokens into groups.
How often a pair of ids is linked in the whole corpus says how well the two correspond.

1. Texts are cut into units, before every single space behind a character that surely is no
   white space. Neither tokenizer joins across such a place; that is read from the tokenizers'
   files, and where they do not warrant it a text is one unit. A unit is encoded once and
   remembered by the worker, within a bound.
2. The units that a batch needs are merged in lockstep: one vector of pointers into A and one
   into B advance for all of them at once, every step emits the links and cuts of the units
   whose tokens end together, and finished units are taken out of the vectors. A place between
   units is a cut of both, so the links of a text are those of its units.
3. A chunk of documents is one row: its distinct pairs with their counts, its units, and which
   units its documents have. Chunks are bounded in rows and bytes and written before they are
   used, so a lost executor does not change which chunk a document is in.
4. Pairs are counted over all chunks. The counts go back to the chunks by pair, frequent pairs
   spread over all tasks, and are added up per document through its units.

Results for unusual input: a null or empty text, or one that the tokens of A or B do not spell
byte by byte (B cannot tell U+2581 from a space), has no tokens, no groups and zeros; special
tokens spelt in a text are plain text; a null id is kept; repeated rows are aligned and counted
as often as they occur; an empty table gives no rows; other columns are ignored, whatever
their names. Of the result ``groups`` holds the ids as ``a1,a2|b1;a3|b2,b3``; a group's link
is the last id on either side.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.llm.blobs import pack, pack_arrays, unpack, unpack_arrays
from goldkeep.llm.words import Words, equal_bytes, runs, text_bytes
from goldkeep.operators.joins import attach
from goldkeep.shared import scratch_path, settle

#: Documents and bytes of text of a chunk; a longer text is a chunk of its own.
CHUNK_ROWS, CHUNK_BYTES = 1000, 4 << 20
#: Units and bytes of them that a worker remembers before it starts anew.
REMEMBERED_UNITS, REMEMBERED_BYTES = 200_000, 16 << 20
SPACE = 0x20


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable bytes are
    themselves, the others follow in order from 256."""
    # fixed values: the bytes that stand for themselves
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def align(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray):
    """Linked tokens ``(a, b)`` of many documents, in order.

    Document d has the tokens ``first_a[d]`` up to ``first_a[d + 1]`` of A, which end at the
    bytes ``ends_a`` of it, and the same for B. All documents advance together.
    """
    a, stop_a = first_a[:-1].copy(), first_a[1:]
    b, stop_b = first_b[:-1].copy(), first_b[1:]
    links_a, links_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    live = (a < stop_a) & (b < stop_b)
    a, b, stop_a, stop_b = a[live], b[live], stop_a[live], stop_b[live]
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        links_a.append(a[cut])
        links_b.append(b[cut])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        live = (a < stop_a) & (b < stop_b)
        if not live.all():
            a, b, stop_a, stop_b = a[live], b[live], stop_a[live], stop_b[live]
    link_a, link_b = np.concatenate(links_a), np.concatenate(links_b)
    order = np.argsort(link_a)
    return link_a[order], link_b[order]


class _Spelling:
    """Which bytes each id of a tokenizer stands for."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens] or [0], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens) or b" ", np.uint8)

    def spelt(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens, and how many bytes each unit has."""
        length = self.length[ids]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(length, out=total[1:])
        stop = np.cumsum(counts)
        return self.data[runs(self.start[ids], length)], total[stop] - total[stop - counts]


def _flat(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.fromiter((i for p in parts for i in p), np.int64, int(counts.sum())), counts


class Aligner:
    """Units, their tokens and links, remembered within a bound."""

    def __init__(self, a_file: str, b_file: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=b_file)
        letters = byte_letters()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        spell_a = [bytes(letters[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        spell_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.spell_a, self.spell_b = _Spelling(spell_a), _Spelling(spell_b)
        self.cuts = self._a_cuts(a_file) and self._b_cuts(b_file, pieces)
        self.forget()

    @staticmethod
    def _a_cuts(file: str) -> bool:
        """Whether A surely never joins a character to white space behind it."""
        with open(file, encoding="utf-8") as held:
            own = json.load(held)
        step = own["pre_tokenizer"] or {}
        return (
            own["normalizer"] is None
            and own["model"]["type"] == "BPE"
            and not own["model"].get("dropout")
            and step.get("type") == "ByteLevel"
            and step.get("use_regex") is True
            and step.get("add_prefix_space") is False
            and all(t["special"] for t in own["added_tokens"])
        )

    def _b_cuts(self, file: str, pieces: list[str]) -> bool:
        """Whether B surely never joins a character to a space behind it, changes no text and
        knows every byte."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(file, "rb") as held:
            model.ParseFromString(held.read())
        rule, trained = model.normalizer_spec, model.trainer_spec
        return (
            trained.model_type == trained.BPE
            and not rule.precompiled_charsmap
            and rule.add_dummy_prefix
            and rule.escape_whitespaces
            and not rule.remove_extra_whitespaces
            and not trained.treat_whitespace_as_suffix
            and sum(self.b.is_byte(i) for i in range(len(pieces))) == 256
            and not any(re.search("[^▁]▁", p) for p in pieces)
        )

    def forget(self) -> None:
        none = np.zeros(0, np.int64)
        self.place: dict[str, int] = {}
        self.n_a = self.n_b = self.n_links = none
        self.good = np.zeros(0, bool)
        self.links, self.groups, self.bytes = none, [], 0

    def units(self, texts: pa.Array) -> Words:
        """The units of all texts, each without the space that it begins with."""
        data, offsets = text_bytes(texts)
        n = len(data)
        full = np.flatnonzero(np.diff(offsets) > 0)
        begins = np.zeros(n, bool)
        if self.cuts and n > 2:
            before, lead, lead3 = data[:-1], np.zeros(n - 1, np.uint8), np.zeros(n - 1, np.uint8)
            lead[1:], lead3[2:] = data[:-2], data[:-3]
            ascii_ = (before > SPACE) & (before < 0x7F)
            # other white space begins with one of these bytes
            beyond = (before >= 0x80) & (lead != 0xC2) & ((lead3 < 0xE1) | (lead3 > 0xE3))
            begins[1:] = (data[1:] == SPACE) & (ascii_ | beyond)
            begins[offsets[:-1][full]] = False  # a space at the beginning of a text
            begins[offsets[1:][full] - 1] = False  # a unit has more than its space
        cut = np.flatnonzero(begins)
        starts = np.sort(np.concatenate([offsets[:-1][full], cut + 1]))
        ends = np.sort(np.concatenate([offsets[1:][full], cut]))
        return Words(data, starts, ends, np.searchsorted(starts, offsets))

    def learn(self, bodies: list[str]) -> None:
        """Encode and align new units."""
        ids_a, count_a = _flat([e.ids for e in self.a.encode_batch_fast([" " + u for u in bodies], add_special_tokens=False)])
        ids_b, count_b = _flat(self.b.encode(bodies, num_threads=1))
        raw = [b" " + u.encode() for u in bodies]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        want, at = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size
        good = np.ones(len(bodies), bool)
        for spelling, ids, count in ((self.spell_a, ids_a, count_a), (self.spell_b, ids_b, count_b)):
            data, length = spelling.spelt(ids, count)
            own = np.cumsum(length) - length
            good &= equal_bytes(data, own, own + length, want, at, at + size)
        first_a, first_b = np.append(0, np.cumsum(count_a)), np.append(0, np.cumsum(count_b))
        ends_a = np.cumsum(self.spell_a.length[ids_a])  # of all units one after another
        ends_b = np.cumsum(self.spell_b.length[ids_b])
        before_a, before_b = np.append(0, ends_a)[first_a[:-1]], np.append(0, ends_b)[first_b[:-1]]
        link_a, link_b = align(
            ends_a - np.repeat(before_a, count_a), first_a, ends_b - np.repeat(before_b, count_b), first_b
        )
        per_unit = np.searchsorted(link_a, first_a)
        text_a, text_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        stop_a, stop_b = (link_a + 1).tolist(), (link_b + 1).tolist()
        bounds, all_a, all_b = per_unit.tolist(), first_a.tolist(), first_b.tolist()
        for unit in range(len(bodies)):
            x, y, parts = all_a[unit], all_b[unit], []
            for k in range(bounds[unit], bounds[unit + 1]):
                parts.append(",".join(text_a[x : stop_a[k]]) + "|" + ",".join(text_b[y : stop_b[k]]))
                x, y = stop_a[k], stop_b[k]
            self.groups.append(";".join(parts))
        self.place.update(zip(bodies, range(len(self.place), len(self.place) + len(bodies))))
        self.n_a, self.n_b = np.append(self.n_a, count_a), np.append(self.n_b, count_b)
        self.n_links = np.append(self.n_links, np.diff(per_unit))
        self.good = np.append(self.good, good)
        self.links = np.append(self.links, ids_a[link_a] << 32 | ids_b[link_b])
        self.bytes += int(size.sum())

    def chunk(self, texts: pa.Array) -> tuple[dict, dict, pa.Array]:
        """Arrays per document; pairs, units and documents of the chunk; groups per unit."""
        units = self.units(texts)
        coded = units.strings().dictionary_encode()
        known = coded.dictionary.to_pylist()
        if len(self.place) > REMEMBERED_UNITS or self.bytes > REMEMBERED_BYTES:
            self.forget()
        new = [u for u in known if u not in self.place]
        if new:
            self.learn(new)
        slot = np.fromiter((self.place[u] for u in known), np.int64, len(known))
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

        def per_text(values: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(values))
            return total[units.first[1:]] - total[units.first[:-1]]

        sound = per_text(~self.good[slot][code]) == 0
        code = code[np.repeat(sound, units.counts)]
        counts = np.where(sound, units.counts, 0)
        first = np.append(0, np.cumsum(counts))
        used, code, times = np.unique(code, return_inverse=True, return_counts=True)
        unit = slot[used]

        def per_document(values: np.ndarray) -> np.ndarray:
            total = np.append(0, np.cumsum(values[code]))
            return total[first[1:]] - total[first[:-1]]

        n_links = self.n_links[unit]
        before = np.append(0, np.cumsum(self.n_links))[unit]
        pairs, place = np.unique(self.links[runs(before, n_links)], return_inverse=True)
        linked = np.zeros(len(pairs), np.int64)
        np.add.at(linked, place, np.repeat(times, n_links))
        links = per_document(n_links)
        own = {
            "n_a": per_document(self.n_a[unit]),
            "n_b": per_document(self.n_b[unit]),
            "n_groups": links,
            "n_links": links,
        }
        held = {
            "counts": counts.astype(np.int32),
            "code": code.astype(np.int32),
            "n_links": n_links.astype(np.int32),
            "place": place.astype(np.int32),
        }
        spelt = pa.array([self.groups[u] for u in unit.tolist()], pa.large_string())
        return own, {"pairs": pairs, "times": linked, "held": held}, spelt


@functools.lru_cache(maxsize=1)
def aligner(a_file: str, b_file: str) -> Aligner:
    """The aligner of this worker process; what it has learnt serves later tasks as well."""
    return Aligner(a_file, b_file)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices bounded in rows and, but for a single longer text, in bytes."""
    _, offsets = text_bytes(batch.column(1))
    start = 0
    while start < batch.num_rows:
        fits = int(np.searchsorted(offsets, offsets[start] + CHUNK_BYTES, "right")) - 1
        stop = min(max(start + 1, fits), start + CHUNK_ROWS, batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


DOCUMENT = ("n_a", "n_b", "n_groups", "n_links")
CHUNK_SCHEMA = (
    "chunk long, ids array<{id}>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, pairs array<long>, times array<long>, units binary, held binary"
)


def _align_chunks(a_file: str, b_file: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_file, b_file)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in _chunks(batch):
                documents, chunk, groups = own.chunk(part.column(1))
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([number], pa.int64()),
                        "ids": pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                        **{c: pa.array([documents[c]], pa.list_(pa.int64())) for c in DOCUMENT},
                        "pairs": pa.array([chunk["pairs"]], pa.list_(pa.int64())),
                        "times": pa.array([chunk["times"]], pa.list_(pa.int64())),
                        "units": pa.array([pack(pa.table({"groups": groups}))], pa.binary()),
                        "held": pa.array([pack_arrays(**chunk["held"])], pa.binary()),
                    }
                )
                number += 1

    return cut


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the counts of their pairs in, documents out."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {n: batch.column(n)[row] for n in batch.schema.names}
            held = unpack_arrays(one["held"].as_py())
            groups = unpack(one["units"].as_py())["groups"].to_pylist()
            found = one["found"].values
            count = np.zeros(0, np.int64) if found is None else found.field("count").to_numpy()
            best = count if found is None else found.field("best").to_numpy()
            first = np.append(0, np.cumsum(held["counts"]))
            stop = np.cumsum(held["n_links"], dtype=np.int64)

            def per_document(values: np.ndarray) -> np.ndarray:
                total = np.append(0, np.cumsum(values[held["place"]]))
                unit = total[stop] - total[stop - held["n_links"]]
                total = np.append(0, np.cumsum(unit[held["code"]]))
                return total[first[1:]] - total[first[:-1]]

            said = [groups[u] for u in held["code"].tolist()]
            bounds = first.tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": one["ids"].values,
                    **{c: one[c].values for c in DOCUMENT},
                    "n_best": pa.array(per_document(best)),
                    "count_sum": pa.array(per_document(count)),
                    "groups": pa.array(
                        [";".join(said[x:y]) for x, y in zip(bounds, bounds[1:])], pa.string()
                    ),
                }
            )


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair`` (A id above bit 32, B id below), its ``count``, and ``best``: 1 where no pair
    with the same B id has a higher one."""
    said = chunks.select(F.inline(F.arrays_zip("pairs", "times")))
    counted = settle(said.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count")))
    of_b = F.col("pair").bitwiseAND((1 << 32) - 1)
    most = counted.groupBy(of_b.alias("b")).agg(F.max("count").alias("most"))
    ranked = attach(counted.withColumn("b", of_b), settle(most), {"b": "b"}, how="inner")
    return settle(ranked.select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")))


def align_texts(
    docs: DataFrame, a_file: str, b_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups`` of all documents. Both files must lie at the same place on every executor."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema, path = CHUNK_SCHEMA.format(id=kind), scratch_path(spark, "aligned")
    aligned = rows.mapInArrow(_align_chunks(a_file, b_file), schema)
    aligned.write.option("compression", "zstd").parquet(path)
    chunks = spark.read.schema(schema).parquet(path)
    pairs = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    found = attach(pairs, pair_counts(chunks), {"pair": "pair"}, how="inner")
    answers = found.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("found"))
    whole = chunks.select("chunk", "ids", *DOCUMENT, "units", "held").join(answers, "chunk", "left")
    return whole.mapInArrow(
        _sum_up,
        f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string",
    )
