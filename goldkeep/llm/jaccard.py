"""Documents linked by the Jaccard similarity of their word n-grams.

A document is the set of its distinct shingles, and an inverted list of a shingle is the set of
documents that have it. A document can only be linked to one with which it shares a required
number T of shingles (T-occurrence). Shingles are ordered by the length of their lists, short
ones first. Of n shingles the first n - T + t contain t common ones, whatever the partner: so
short lists alone bring up all candidates, and long ones need only be probed.

1. A fixed table of counters, filled from all documents, estimates list lengths. Any fixed
   order gives right results; a good one keeps lists short.
2. Documents with equal sets are one from here on; the smallest id stands for them.
3. The first shingles of every set meet in buckets by hash. A list of at most ``LIST`` documents
   yields pairs. A longer list does not: it is noted how many long lists a document is in, and
   what two documents may share in those, the lesser number at most, is added to the times that
   they meet as a pair. Pairs that this may make often enough are kept. Documents that can be
   linked through long lists alone are tied, in each of these lists, to others of similar size.
   What is tied or kept is a family.
4. Only documents of families are read again. Within a family, each document searches all
   others: merge its short inverted lists by a heap, keep what occurs T - L times, probe the L
   longest lists by binary search, drop what can no longer reach T. Lists of the same documents
   count as one with a weight. A family that is too large for one task is dealt to blocks of
   bounded size; each sends its sets, numbered and packed, to the cells where two blocks meet,
   one copy after another.
5. Every link is found and counted for both ends, with the rows that have equal sets. Links
   themselves are reported as far as they span what they connect, and joined to components.

Results for unusual input: a null or wordless text has the empty set, is linked with nothing and
is its own component; a text of fewer words than a shingle has its whole sequence as the only
shingle; rows that repeat an id are linked under that id; rows with a null id are given a null
component and number of links, and count for no other row; an empty table gives no rows; other columns are ignored, and kept by ``keep_one``.
Ids are integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldkeep.llm.blobs import groups_for, pack, pack_arrays, unpack, unpack_arrays
from goldkeep.llm.components import components
from goldkeep.llm.words import (
    WHITE_SPACE,
    gram_hashes,
    gram_places,
    mix,
    runs,
    slices,
    split,
    word_hashes,
)
from goldkeep.operators.joins import attach, fits_broadcast
from goldkeep.shared import settle

SHINGLE = 4
#: Links need ``100 * intersection >= percent * union``.
PERCENT = 85
#: Counters of list lengths, and how many of them travel in one row.
COUNTERS, COUNTER_ROW = 1 << 22, 1 << 13
#: Longest list that is turned into pairs.
LIST = 16
#: Bytes of postings in a bucket, about; documents and shingles in a block of a large family.
BUCKET_BYTES, CELL, CELL_SHINGLES = 8 << 20, 1000, 1 << 19
#: Texts of a block that are cut into shingles at once.
TEXTS = 50
#: Cost of merging against probing; sets how many of the longest lists are only probed.
SKIP = 0.01
#: Bits of the filter for documents that are read again.
FILTER_BITS = 1 << 23

#: What stands for a set, its rows' ids apart.
PRINTS = ["size", "print1", "print2"]

_FOUND = pa.schema(
    [
        ("kind", pa.string()),
        *[(c, pa.int64()) for c in ("id", *PRINTS, "other", "n", "component")],
        ("own", pa.int32()),
        ("blocks", pa.int32()),
        ("blob", pa.binary()),
    ]
)
_FOUND_TYPES = (
    "kind string, id long, size long, print1 long, print2 long, other long, n long, component long, "
    "own int, blocks int, blob binary"
)


def required(size: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap that links sets of these sizes."""
    return -(-percent * (size + other) // (100 + percent))


def extra(size: np.ndarray) -> np.ndarray:
    """How many common shingles the first ones of a linked pair have at least."""
    return 1 + size // 20


def prefix(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of the first shingles are needed for that."""
    smallest_partner = -(-percent * size // 100)
    return np.minimum(size, size - required(size, smallest_partner, percent) + extra(size))


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, repeats included, and where each text's begin."""
    words = split(texts, WHITE_SPACE, lower=True)
    hashes = word_hashes(words)
    counts = words.counts
    number = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(number)])
    out = np.zeros(first[-1], np.uint64)
    long = counts >= n
    places = gram_places(words.first, n)
    if len(places):
        out[runs(first[:-1][long], number[long])] = gram_hashes(hashes, n)[places]
    for few in range(1, n):
        short = np.flatnonzero(counts == few)
        if len(short):
            out[first[short]] = gram_hashes(hashes, few)[words.first[short]]
    return out, first


def _count_lists(n: int):
    """Texts in, counters of shingle hashes out, in rows of a fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches):
            hashes, _ = shingle_sets(batch.column(0), n)
            np.add.at(total, (hashes & np.uint64(COUNTERS - 1)).view(np.int64), 1)
        rows = total.reshape(-1, COUNTER_ROW)
        used = np.flatnonzero(rows.any(axis=1))
        if len(used):
            # in as few bytes a counter as the row admits
            held = [rows[i].astype(np.min_scalar_type(rows[i].max())).tobytes() for i in used.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(held, pa.binary())], ["slot", "counts"]
            )

    return count


def _add_counters(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTER_ROW, np.int64)
    for batch in batches:
        for counts in batch.column("counts"):
            held = np.frombuffer(counts.as_buffer(), np.uint8)
            total += held.view(f"u{len(held) // COUNTER_ROW}")
    total = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])], ["slot", "counts"])


def list_lengths(texts: DataFrame, n: int) -> np.ndarray:
    """Upper bounds of the lengths of all inverted lists, by the low bits of the shingle."""
    counted = texts.mapInArrow(_count_lists(n), "slot int, counts binary")
    added = counted.groupBy("slot").applyInArrow(_add_counters, "slot int, counts binary").collect()
    total = np.zeros((COUNTERS // COUNTER_ROW, COUNTER_ROW), np.int32)
    for row in added:  # a fixed number of rows
        total[row["slot"]] = np.frombuffer(row["counts"], np.int32)
    return total.ravel()


def _prints(own: np.ndarray) -> tuple[int, int]:
    """Two fingerprints of a set of shingles, both zero for the empty one."""
    if not len(own):
        return 0, 0
    mixed = mix(own)
    other = np.bitwise_xor.reduce(mix(mixed + np.uint64(1)))
    return int(mixed.sum().view(np.int64)), int(other.view(np.int64))


def _describe(lengths, n: int, percent: int):
    """Documents in; size, fingerprint and first shingles of each set out."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, first = shingle_sets(batch.column(1), n)
            size, one, two, head = [], [], [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own = np.unique(hashes[a:b])
                sum_of, xor_of = _prints(own)
                size.append(len(own))
                one.append(sum_of)
                two.append(xor_of)
                order = np.argsort(
                    lengths.value[(own & np.uint64(COUNTERS - 1)).view(np.int64)], kind="stable"
                )
                head.append(own[order[: int(prefix(np.int64(len(own)), percent))]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size, pa.int64()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array(head, pa.binary()),
                ],
                ["id", "size", "print1", "print2", "head"],
            )

    return describe


def _post(buckets: int):
    """Sets in, their first shingles as postings for each bucket out."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = batch.column(2).to_pylist()
            shingle = np.frombuffer(b"".join(heads), np.uint64)
            count = np.array([len(h) // 8 for h in heads], np.int64)
            bucket = (mix(shingle) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            of = np.repeat(np.arange(len(heads)), count)[order]
            postings = pa.table(
                {
                    "shingle": shingle[order],
                    "id": batch.column(0).to_numpy(zero_copy_only=False)[of],
                    "size": batch.column(1).to_numpy(zero_copy_only=False)[of],
                }
            )
            used, first = np.unique(bucket[order], return_index=True)
            ends = np.append(first[1:], len(order))
            blobs = [pack(postings.slice(a, b - a)) for a, b in zip(first.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "blob"]
            )

    return post


def _similar_size(small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
    return 100 * small >= percent * large


def _meet(percent: int):
    """All postings of a bucket in; pairs (u, v) with the number of lists of at most ``LIST``
    documents that they meet in, and, marked ``long``, documents u in longer lists out. There v is
    a number for the list and those of similar size, and ``need`` how many lists a link of u needs."""

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        postings = pa.concat_tables([unpack(b) for b in table["blob"].to_pylist()])
        shingle, ids, size = (postings[c].to_numpy() for c in ("shingle", "id", "size"))
        order = np.lexsort((ids, size, shingle))
        shingle, ids, size = shingle[order], ids[order], size[order]
        first = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
        length = np.diff(first, append=len(shingle))
        found = []
        for m in range(2, LIST + 1):
            start = first[length == m]
            for i in range(m):
                for j in range(i + 1, m):
                    a, b = start + i, start + j
                    fits = _similar_size(size[a], size[b], percent)
                    a, b = a[fits], b[fits]
                    found.append(np.stack([ids[a], ids[b], np.minimum(extra(size[a]), extra(size[b]))]))
        pairs = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
        low, high = np.minimum(pairs[0], pairs[1]), np.maximum(pairs[0], pairs[1])
        u, v, need, times = _tally(low, high, pairs[2])

        # documents of a long list that differ too much in size are not linked, nor what they end
        long = length > LIST
        at = runs(first[long], length[long])
        of = np.repeat(np.arange(int(long.sum())), length[long])
        new = np.ones(len(at), bool)
        new[1:] = (of[1:] != of[:-1]) | ~_similar_size(size[at[:-1]], size[at[1:]], percent)
        # equal numbers of two stretches would tie more, not less
        stretch = mix(shingle[at] ^ mix(np.cumsum(new).astype(np.uint64))).view(np.int64)
        least = extra(-(-percent * size[at] // 100))
        return pa.table(
            {
                "u": np.concatenate([u, ids[at]]),
                "v": np.concatenate([v, stretch]),
                "need": np.concatenate([need, least]),
                "times": np.concatenate([times, np.ones(len(at), np.int64)]),
                "long": np.arange(len(u) + len(at)) >= len(u),
            }
        )

    return meet


def _tally(low: np.ndarray, high: np.ndarray, need: np.ndarray):
    order = np.lexsort((high, low))
    low, high, need = low[order], high[order], need[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(new)
    return low[at], high[at], need[at], np.diff(at, append=len(low))


def _reread(seen, n: int):
    """Texts in; those whose id the filter admits, with size and fingerprints of their set, out."""

    def reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(seen.value, np.uint8)).view(bool)
        for batch in slices(batches):
            slot = batch.column("slot").to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(bits[slot]))
            hashes, first = shingle_sets(batch.column("text"), n)
            sets = [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            told = np.array([(len(s), *_prints(s)) for s in sets], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, told.T), batch.column("text")], ["id", *PRINTS, "text"]
            )

    return reread


@dataclass
class _Block:
    """Documents of a family, ordered by size: id, size, fingerprints and how many rows have that
    set. Shingles are numbered by ``known``; ``number`` has the sets one after another."""

    docs: dict[str, np.ndarray]
    known: np.ndarray
    number: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, n: int) -> _Block:
        table = table.sort_by([("size", "ascending"), ("id", "ascending")])
        sets = []
        for part in slices(table.select(["text"]).to_batches(), TEXTS):
            hashes, first = shingle_sets(part.column(0), n)
            sets += [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        known, number = np.unique(np.concatenate(sets), return_inverse=True)
        return cls({c: table[c].to_numpy() for c in ("id", *PRINTS, "weight")}, known, number)

    def pack(self) -> bytes:
        steps = np.diff(self.known, prepend=np.uint64(0))
        return pack_arrays(**self.docs, known=steps, number=self.number.astype(np.int32))

    @classmethod
    def unpack(cls, blob: bytes) -> _Block:
        held = unpack_arrays(blob)
        return cls(held, np.cumsum(held.pop("known")), held.pop("number").astype(np.int64))

    def sets(self) -> list[np.ndarray]:
        return np.split(self.number, np.cumsum(self.docs["size"])[:-1])


class _Index:
    """Inverted lists of a block: (list, document) in one number, sorted. Documents are ordered by
    size, so partners of fitting size are a stretch of every list."""

    def __init__(self, block: _Block, percent: int):
        self.percent, self.sizes = percent, block.docs["size"]
        self.n = len(self.sizes)
        of = np.repeat(np.arange(self.n), self.sizes)
        self.pairs = np.sort(block.number * self.n + of)
        first = np.searchsorted(self.pairs, np.arange(len(block.known)) * self.n)
        held = mix((self.pairs % self.n + 1).astype(np.uint64))
        # lists of the same documents are merged and probed once, with their number as weight
        _, self.kind = np.unique(np.add.reduceat(held, first), return_inverse=True)

    def search(self, own: np.ndarray, size: int, low: int) -> np.ndarray:
        """Documents from ``low`` on that are linked to a set of ``size`` shingles, ``own`` being
        those of them that occur here."""
        nothing = np.zeros(0, np.int64)
        low = max(low, int(np.searchsorted(self.sizes, -(-self.percent * size // 100))))
        high = int(np.searchsorted(self.sizes, 100 * size // self.percent, "right"))
        if low >= high:
            return nothing
        need = required(self.sizes[low:high], size, self.percent)
        least = int(need[0])
        if len(own) < least:
            return nothing
        _, one, weight = np.unique(self.kind[own], return_index=True, return_counts=True)
        lists = own[one] * self.n
        start, stop = np.searchsorted(self.pairs, np.stack([lists + low, lists + high]))
        order = np.argsort(stop - start, kind="stable")
        order = order[np.count_nonzero(start == stop) :]
        lists, start, stop, weight = lists[order], start[order], stop[order], weight[order]
        if weight.sum() < least:
            return nothing
        # DivideSkip: the longest lists are set aside and only probed
        longest = int(stop[-1] - start[-1])
        aside = min(least - 1, int(least / (SKIP * np.log(max(2, longest)) + 1)))
        short = len(order) - int(np.searchsorted(np.cumsum(weight[::-1]), aside, "right"))
        found, times = self._merge(start[:short], stop[:short], weight[:short])
        left = int(weight[short:].sum())
        reach = times >= need[found - low] - left
        found, times = found[reach], times[reach]
        for i in range(short, len(order), 64):
            if not len(found):
                break
            probe = lists[i : i + 64, None] + found[None, :]
            at = np.minimum(np.searchsorted(self.pairs, probe), len(self.pairs) - 1)
            times = times + weight[i : i + 64] @ (self.pairs[at] == probe)
            left -= int(weight[i : i + 64].sum())
            reach = times >= need[found - low] - left
            found, times = found[reach], times[reach]
        return found

    def _merge(self, start: np.ndarray, stop: np.ndarray, weight: np.ndarray):
        """Documents of some lists, in order, and the weight of the lists that hold them. The
        lists are merged by a heap of their heads."""
        k = len(start)
        held = [
            (self.pairs[a:b] % self.n * k + i).tolist()
            for i, (a, b) in enumerate(zip(start.tolist(), stop.tolist()))
        ]
        merged = np.fromiter(heapq.merge(*held), np.int64)
        docs, of = np.divmod(merged, k)
        first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        return docs[first], np.add.reduceat(weight[of], first)


def _compare(a: _Block, b: _Block, percent: int) -> tuple[dict, np.ndarray, list[tuple]]:
    """The documents of one or two blocks, how many rows each is linked to within the block or
    across the two, and links that span what all links connect."""
    index, within = _Index(b, percent), a is b
    docs, shift = a.docs, 0
    place = np.arange(len(b.known))
    if not within:
        docs = {c: np.concatenate([a.docs[c], b.docs[c]]) for c in a.docs}
        shift = len(a.docs["id"])
        at = np.minimum(np.searchsorted(b.known, a.known), len(b.known) - 1)
        place = np.where(b.known[at] == a.known, at, -1)
    ids, size, weight = docs["id"], docs["size"], docs["weight"]
    group, counts = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    links = []
    for x, own in enumerate(a.sets()):
        here = place[own]
        found = index.search(here[here >= 0], int(size[x]), x + 1 if within else 0) + shift
        counts[x] += weight[found].sum()
        counts[found] += weight[x]
        for y in found[group[found] != group[x]].tolist():
            if group[y] != group[x]:
                links.append((ids[x], ids[y]))
                group[group == group[y]] = group[x]
    return docs, counts, links


def _told(docs: dict, counts: np.ndarray, links: list[tuple], block: pa.Table | None = None) -> pa.Table:
    at = np.flatnonzero(counts)
    ends = np.array(links, np.int64).reshape(-1, 2)
    counted = {c: docs[c][at] for c in ("id", *PRINTS)}
    parts = [
        _FOUND.empty_table(),
        pa.table({"kind": pa.array(["count"] * len(at), pa.string()), **counted, "n": counts[at]}),
        pa.table({"kind": pa.array(["link"] * len(ends), pa.string()), "id": ends[:, 0], "other": ends[:, 1]}),
    ]
    if block is not None:
        parts.append(block)
    return pa.concat_tables(parts, promote_options="default")


def _within(n: int, percent: int):
    """The documents of a block in; links within it and, if its family has more blocks, the
    packed block out."""

    def within(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blocks = table["blocks"][0].as_py()
        block = _Block.of(table, n)
        packed = None
        if blocks > 1:
            packed = pa.table(
                {
                    "kind": ["block"],
                    "component": pa.array([key[0].as_py()], pa.int64()),
                    "own": pa.array([key[1].as_py()], pa.int32()),
                    "blocks": pa.array([blocks], pa.int32()),
                    "blob": pa.array([block.pack()], pa.binary()),
                }
            )
        return _told(*_compare(block, block, percent), packed)

    return within


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed blocks in; a copy for each cell with another block out, made one at a time: Spark's
    own ``explode`` makes all copies of a row before it hands on the first."""
    names = ["component", "row", "column", "own", "blob"]
    for batch in batches:
        for i in range(batch.num_rows):
            component, own, blob = (batch.column(c).slice(i, 1) for c in ("component", "own", "blob"))
            one = own[0].as_py()
            for other in range(batch.column("blocks")[i].as_py()):
                if other != one:
                    ends = [pa.array([end], pa.int32()) for end in (min(one, other), max(one, other))]
                    yield pa.RecordBatch.from_arrays([component, *ends, own, blob], names)


def _across(percent: int):
    """Two blocks of a family in, links between them out."""

    def across(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blocks = [_Block.unpack(b) for b in table.sort_by("own")["blob"].to_pylist()]
        if len(blocks) < 2:  # no document is in the other one
            return _FOUND.empty_table()
        return _told(*_compare(*blocks, percent))

    return across


def _families(rows: DataFrame, percent: int) -> DataFrame:
    """Ids that may have partners, with the family they have to be looked for in."""
    size = rows.agg(F.sum(F.octet_length("head") * 3)).first()[0] or 0
    posted = rows.select("id", "size", "head").mapInArrow(
        _post(groups_for(size, BUCKET_BYTES)), "bucket int, blob binary"
    )
    met = settle(
        posted.groupBy("bucket").applyInArrow(
            _meet(percent), "u long, v long, need long, times long, long boolean"
        ),
        few=True,
    )
    # how many long lists a document is in, and how many a link through them alone needs
    many = met.where("long").groupBy("u").agg(F.sum("times").alias("many"), F.min("need").alias("least"))
    many = settle(many.select(F.col("u").alias("id"), "many", "least"))
    pairs = met.where("not long").groupBy("u", "v").agg(F.min("need").alias("need"), F.sum("times").alias("times"))
    pairs = settle(pairs, few=True)
    short = pairs.where("times < need")
    for end in "uv":
        both = many.select("id", F.col("many").alias(f"many_{end}"))
        short = attach(short, both, {end: "id"}, how="inner")
    kept = pairs.where("times >= need").unionByName(
        short.where("times + least(many_u, many_v) >= need").select(pairs.columns)
    )
    return components(kept.select("u", "v").unionByName(_ties(met, many)))


def _ties(met: DataFrame, many: DataFrame) -> DataFrame:
    """Pairs that tie what long lists alone may link: documents in as many as a link needs, to the
    smallest id of their list and size."""
    able = many.where("many >= least").select("id", F.lit(True).alias("able"))
    in_long = met.where("long").select("u", F.col("v").alias("stretch"))
    in_long = settle(attach(in_long, settle(able), {"u": "id"}, how="inner").select("u", "stretch"))
    roots = in_long.groupBy("stretch").agg(F.min("u").alias("root"), F.max("u").alias("last"))
    roots = settle(roots.where("root <> last").select("stretch", "root"))
    tied = attach(in_long, roots, {"stretch": "stretch"}, how="inner").where("u <> root")
    return tied.select(F.col("root").alias("u"), F.col("u").alias("v"))


def _blocks(same: DataFrame, families: DataFrame) -> DataFrame:
    """Sets of families with the block of the family they are in."""
    members = settle(same.drop("head").join(families.withColumnRenamed("node", "id"), "id"))
    totals = members.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("members") / CELL), F.ceil(F.col("shingles") / CELL_SHINGLES)).cast("int")
    totals = settle(totals.select("component", blocks.alias("blocks")))
    placed = attach(members, totals, {"component": "component"}, how="inner")
    return placed.withColumn("own", F.pmod(F.xxhash64("id", *PRINTS), F.col("blocks")).cast("int"))


def _search_families(
    texts: DataFrame, same: DataFrame, families: DataFrame, shingle: int, percent: int
) -> DataFrame:
    """Numbers of links (kind ``count``) and spanning links (kind ``link``) of all families."""
    sent = texts.sparkSession.sparkContext.broadcast(_filter_of(families))
    again = texts.where("id is not null").withColumn("slot", _slot("id"))
    again = again.mapInArrow(
        _reread(sent, shingle), "id long, size long, print1 long, print2 long, text string"
    )
    again = again.groupBy("id", *PRINTS).agg(F.first("text").alias("text"))
    inside = settle(
        again.join(_blocks(same, families), ["id", *PRINTS])
        .groupBy("component", "own")
        .applyInArrow(_within(shingle, percent), _FOUND_TYPES),
        few=True,
    )
    cells = inside.where("kind = 'block'").select("component", "own", "blocks", "blob").mapInArrow(
        _sent, "component long, row int, column int, own int, blob binary"
    )
    between = settle(
        cells.groupBy("component", "row", "column").applyInArrow(_across(percent), _FOUND_TYPES),
        few=True,
    )
    return inside.where("kind <> 'block'").unionByName(between).drop("blob")


def _filter_of(ids: DataFrame) -> bytes:
    """A bit for the slot of every id. Its size is fixed, and no id of ``ids`` fails it."""
    bits = ids.select((_slot("node") / 8).cast("int").alias("byte"), (_slot("node") % 8).alias("bit"))
    held = bits.groupBy("byte").agg(F.bit_or(F.expr("shiftright(128, bit)")).alias("bits")).toArrow()
    packed = np.zeros(FILTER_BITS // 8, np.uint8)
    packed[held["byte"].to_numpy()] = held["bits"].to_numpy()
    return packed.tobytes()


def _slot(column: str):
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).cast("int")


def link_documents(
    docs: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: its id, ``n_shingles``, the size of its set, ``component_id``, the
    smallest id that links lead to, and ``n_links``, the number of other rows it is linked to."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    lengths = spark.sparkContext.broadcast(list_lengths(texts.select("text"), shingle))
    described = settle(
        texts.mapInArrow(
            _describe(lengths, shingle, percent), "id long, size long, print1 long, print2 long, head binary"
        ),
        few=True,
    )
    # equal sets have equal first shingles
    same = settle(
        described.where("id is not null and size > 0")
        .groupBy(*PRINTS)
        .agg(F.min("id").alias("id"), F.first("head").alias("head"), F.count(F.lit(1)).alias("weight")),
        few=True,
    )
    families = settle(_families(same, percent))
    found = _search_families(texts, same, families, shingle, percent)

    counts = found.where("kind = 'count'").groupBy("id", *PRINTS).agg(F.sum("n").alias("n"))
    others = F.col("weight") - 1 + F.coalesce("n", F.lit(0))
    lookup = same.drop("head").join(counts, ["id", *PRINTS], "left")
    lookup = settle(lookup.select(*PRINTS, F.col("id").alias("stands"), others.alias("n_links")))
    # a set with a null id only stands for nothing
    rows = settle(attach(described.drop("head"), lookup, {c: c for c in PRINTS}), few=True)

    stands = rows.where("id is not null and stands is not null").select("id", "stands")
    # an id that names several sets links them
    several = stands.groupBy("id").agg(F.min("stands").alias("u"), F.max("stands").alias("last"))
    several = several.where("u <> last").join(stands, "id").select("u", F.col("stands").alias("v"))
    links = found.where("kind = 'link'").select(F.col("id").alias("u"), F.col("other").alias("v"))
    joined = components(links.unionByName(several))
    known = settle(joined.select(F.col("node").alias("stands"), F.col("component").alias("linked")))
    component = attach(stands, known, {"stands": "stands"}).groupBy("id").agg(
        F.min(F.coalesce("linked", "stands")).alias("component")
    )
    return rows.join(component, "id", "left").select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).alias("n_links"),
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` without those that are linked to a document with a smaller id. Rows with a
    null id stay."""
    linked = link_documents(docs, id_column=id_column, **options)
    gone = settle(linked.where(F.col("component_id") < F.col(id_column)).select(id_column).distinct())
    # where the ids fit into a broadcast, no text is shuffled
    return docs.join(F.broadcast(gone) if fits_broadcast(gone) else gone, id_column, "left_anti")
