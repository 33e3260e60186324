"""How far the sources of a language diverge in the words they use.

Terms are runs of letters (A-Z and a-z, in lower case, and all that is not ASCII). A language
keeps the terms of at least ``least`` of its documents. Every group, that is a language and a
source, and every language as a whole gives each kept term the share
``1 + floor(10**9 * (count + 5) / (N + 5 * V))`` of its ``N`` kept occurrences, ``V`` being the
number of kept terms. Two sources are as far apart as the sum of the differences of their
shares; a term marks a source where its share there is above that in the language.

1. Documents per term are counted with map-side combination.
2. The kept terms are sorted over all partitions and numbered, so a smaller ordinal is a smaller
   term of the language. Runs of ``SHARD_TERMS`` of them become minimal transducers, built
   where the runs are.
3. The texts stream through the transducers and come out as ordinals, which are counted per group.
   Transducers go to the tasks in blocks of at most ``BLOCK_BYTES``; a language is read once for
   each block that has terms of it, so memory stays bounded when vocabularies grow.
4. Distances are added up in tiles: a bounded run of ordinals for two bounded sets of sources.
   The result has a row for each pair of sources, which is as many as it must have.

All numbers are whole; they are divided as decimals of 38 digits, so nothing is rounded.

Results for unusual input: a null text, language or source is empty; an empty text has no terms
but its group counts; every row is a document, repeated ones too; a language without kept terms
has distance 0 between its sources and no terms; a very long term is kept whole; an empty table
gives no rows; columns other than the three read are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldkeep.llm.transducer import Transducers, packed
from goldkeep.llm.words import delimiters, slices, split
from goldkeep.operators.joins import attach
from goldkeep.operators.ranking import dense_index
from goldkeep.shared import settle

#: All of ASCII but letters.
NOT_LETTERS = delimiters((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The unit of a share, and what is added to every count.
UNIT, ADDED = 1_000_000_000, 5
#: Terms of one transducer.
SHARD_TERMS = 1 << 16
#: Packed bytes of transducers that a task holds at once.
BLOCK_BYTES = 16 << 20
#: Groups and ordinals that a task counts before it hands its counts on.
COUNTED = 1 << 18
#: Documents that a task reads at once.
SLICE = 250
#: Sources and ordinals of a tile.
TILE_SOURCES, TILE_TERMS = 128, 1024


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """``lang``, ``term`` in at least ``least`` documents, numbered by ``ordinal`` in the
    order of language and term."""
    # fixed values: ASCII without letters, as a pattern
    cut = F.split(F.translate("text", UPPER, LOWER), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+")
    own = docs.select("lang", F.explode(F.array_distinct(cut)).alias("term")).where("term <> ''")
    counted = own.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("documents"))
    kept = counted.where(F.col("documents") >= least).select(F.struct("lang", "term").alias("at"))
    return settle(dense_index(kept, "at", "ordinal").select("at.lang", "at.term", "ordinal"))


def _shard(group: pa.Table) -> pa.Table:
    group = group.sort_by("ordinal")
    terms = [t.encode() for t in group["term"].to_pylist()]
    return pa.table(
        {
            "lang": group["lang"][:1],
            "first": pa.array([terms[0]], pa.binary()),
            "ordinal": group["ordinal"][:1],
            "packed": pa.array([packed(terms)], pa.binary()),
        }
    )


def transducers(kept: DataFrame) -> DataFrame:
    """``lang``, ``first`` term, first ``ordinal`` and ``packed`` transducer of every run."""
    runs = kept.withColumn("run", F.expr(f"ordinal div {SHARD_TERMS}"))
    return settle(
        runs.groupBy("lang", "run").applyInArrow(
            _shard, "lang string, first binary, ordinal long, packed binary"
        )
    )


def _blocks(shards: DataFrame) -> Iterator[list]:
    """Rows of ``shards`` in blocks of at most ``BLOCK_BYTES``, one block at a time."""
    sizes = shards.select("ordinal", F.length("packed").alias("n"))
    total = F.sum("n").over(Window.orderBy("ordinal")) - 1
    dealt = settle(sizes.select("ordinal", F.floor(total / BLOCK_BYTES).alias("block")))
    blocks = shards.join(dealt, "ordinal")
    for block in range((dealt.agg(F.max("block")).first()[0] or 0) + 1):
        held = blocks.where(F.col("block") == block).select("lang", "first", "ordinal", "packed")
        rows = [(r[0], bytes(r[1]), r[2], bytes(r[3])) for r in held.collect()]
        if rows:
            yield rows


class _Counts:
    """Occurrences per group and ordinal of what a task has read since it last handed on."""

    def __init__(self):
        self.groups: dict[tuple, int] = {}
        self.keys, self.times, self.size = [], [], 0

    def add(self, langs: list, sources: list, docs: np.ndarray, ordinals: np.ndarray) -> None:
        """``docs`` and ``ordinals``: the document and the ordinal of every occurrence."""
        group = [self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources)]
        key = np.array(group, np.int64)[docs] << 40 | ordinals
        keys, times = np.unique(key, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self.size += len(keys)

    def take(self) -> pa.RecordBatch:
        keys = np.concatenate(self.keys or [np.zeros(0, np.int64)])
        key, place = np.unique(keys, return_inverse=True)
        times = np.zeros(len(key), np.int64)
        np.add.at(times, place, np.concatenate(self.times or [times]))
        group = pa.array(key >> 40)
        langs, sources = zip(*self.groups) if self.groups else ((), ())
        batch = {
            "lang": pa.array(langs, pa.string()).take(group),
            "source": pa.array(sources, pa.string()).take(group),
            "ordinal": pa.array(key & ((1 << 40) - 1)),
            "n": pa.array(times),
        }
        self.__init__()
        return pa.RecordBatch.from_pydict(batch)


def _stream(shards):
    """Task function: ``lang``, ``source``, ``text`` in, counts of ordinals per group out."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, counts = Transducers(shards.value), _Counts()
        for batch in slices(batches, SLICE):
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words = split(batch.column(2), NOT_LETTERS, lower=True)
            # the vocabulary of each document, and every word once with each vocabulary
            known = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
            of = np.fromiter((known[lang] for lang in langs), np.int64, len(langs))
            docs = words.text_of()
            coded = words.strings().dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            pair, place = np.unique(of[docs] << 32 | code, return_inverse=True)
            text = coded.dictionary.cast(pa.large_binary())
            shard = np.full(len(pair), -1, np.int64)
            for lang, i in known.items():
                mine = np.flatnonzero(pair >> 32 == i)
                several = len(machine.firsts.get(lang, [])) > 1
                spelt = text.take(pa.array(pair[mine] & 0xFFFFFFFF)) if several else mine
                shard[mine] = machine.shard_of(lang, spelt.to_pylist() if several else spelt)
            chosen = pair & 0xFFFFFFFF
            offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
            held = text.buffers()[2]
            data = np.frombuffer(held, np.uint8) if held else np.zeros(1, np.uint8)
            ordinal = machine.ordinals_of(data, offsets[chosen], offsets[chosen + 1], shard)[place]
            hit = ordinal >= 0
            counts.add(langs, sources, docs[hit], ordinal[hit])
            if counts.size > COUNTED:
                yield counts.take()
        yield counts.take()

    return stream


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``ordinal``, ``n``: occurrences of kept terms per group."""
    spark = docs.sparkSession
    schema = "lang string, source string, ordinal long, n long"
    parts, total = [], F.sum("n").alias("n")
    for block in _blocks(shards):
        sent = spark.sparkContext.broadcast(block)
        rows = docs.where(F.col("lang").isin(*{r[0] for r in block}))
        counted = rows.mapInArrow(_stream(sent), schema)
        parts.append(settle(counted.groupBy("lang", "source", "ordinal").agg(total)))
        sent.destroy()
    out = spark.createDataFrame([], schema)
    for part in parts:
        out = out.unionByName(part)
    return out


def _share(count, total, terms):
    def whole(column):
        return column.cast("decimal(19,0)")

    over = whole(total) + whole(F.lit(ADDED) * terms)
    part = F.lit(UNIT).cast("decimal(10,0)") * (whole(count) + F.lit(ADDED).cast("decimal(2,0)"))
    return F.when(terms > 0, F.lit(1) + F.call_function("div", part, over))


def _tile(group: pa.Table) -> pa.Table:
    """Partial distances between the sources of one tile. A row without an ordinal says which
    share a source gives to every term it does not have."""
    low = group["low"][0].as_py()
    width = group["width"][0].as_py()
    side = group["side"].to_numpy()
    names = group["source"].combine_chunks().dictionary_encode()
    # a pair is named the same way round in every tile, in whatever order its rows come in
    order = pc.sort_indices(names.dictionary)
    code = np.argsort(order.to_numpy())[names.indices.to_numpy(zero_copy_only=False)]
    ordinal = group["ordinal"].to_numpy(zero_copy_only=False)
    share = group["share"].to_numpy(zero_copy_only=False)
    base = np.isnan(ordinal.astype(float))
    given = pc.is_valid(group["share"]).to_numpy()

    def matrix(wanted: int) -> tuple[np.ndarray, np.ndarray]:
        mine = side == wanted
        sources, row = np.unique(code[mine], return_inverse=True)
        out = np.zeros((len(sources), width), np.int64)
        whole = base[mine] & given[mine]
        out[row[whole]] = share[mine][whole].astype(np.int64)[:, None]
        single = ~base[mine]
        at = ordinal[mine][single].astype(np.int64) - low
        out[row[single], at] = share[mine][single].astype(np.int64)
        return sources, out

    alone = group["upper"][0].as_py() == group["lower"][0].as_py()
    sources, left = matrix(0)
    others, right = (sources, left) if alone else matrix(1)
    none = np.zeros(0, np.int64)
    a, b, value = [none], [none], [none]
    for i in range(len(sources)):
        chosen = np.arange(i + 1 if alone else 0, len(others))
        a.append(np.full(len(chosen), sources[i]))
        b.append(others[chosen])
        value.append(np.abs(right[chosen] - left[i]).sum(1))
    label = names.dictionary.take(order)
    return pa.table(
        {
            "lang": pa.array([group["lang"][0].as_py()] * sum(map(len, a)), pa.string()),
            "a": label.take(pa.array(np.concatenate(a).astype(np.int64))),
            "b": label.take(pa.array(np.concatenate(b).astype(np.int64))),
            "value": pa.array(np.concatenate(value).astype(np.int64)),
        }
    )


def _distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of every two sources of a language.

    ``groups`` has each group with ``absent``, the share of a term it lacks, and the first and
    last ordinal of its language; ``shares`` the terms it has.
    """
    tiles = F.sequence(
        F.coalesce(F.expr(f"first div {TILE_TERMS}"), F.lit(0)),
        F.coalesce(F.expr(f"last div {TILE_TERMS}"), F.lit(0)),
    )
    bases = groups.select("lang", "source", "blocks", "first", "last", "absent", F.explode(tiles).alias("tile"))
    bases = bases.select(
        "lang", "source", "blocks", "tile", F.lit(None).cast("long").alias("ordinal"),
        F.col("absent").alias("share"), "first", "last",
    )
    rows = bases.unionByName(
        shares.select(
            "lang", "source", "blocks", F.expr(f"ordinal div {TILE_TERMS}").alias("tile"),
            "ordinal", "share", "first", "last",
        )
    )
    low = F.greatest(F.col("tile") * TILE_TERMS, F.coalesce("first", F.lit(0)))
    high = F.least((F.col("tile") + 1) * TILE_TERMS - 1, F.coalesce("last", F.lit(-1)))
    own = F.pmod(F.xxhash64("source"), F.col("blocks"))
    placed = rows.withColumn("low", low).withColumn("width", (high - low + 1).cast("int")).withColumn("own", own)
    cell = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = placed.select("lang", "source", "tile", "ordinal", "share", "low", "width", "own", cell)
    dealt = dealt.select(
        "lang", "source", "tile", "ordinal", "share", "low", "width",
        F.least("own", "other").alias("upper"),
        F.greatest("own", "other").alias("lower"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    cells = dealt.groupBy("lang", "tile", "upper", "lower")
    parts = cells.applyInArrow(_tile, "lang string, a string, b string, value long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )
    return sums.select("lang", "value", F.inline(both))


def audit(docs: DataFrame, least: int = 30, top: int = 50) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: every other source of the
    language by its distance (``pair``) and the ``top`` terms by the surplus of their share
    (``term``), largest first, ties in the order of the items' bytes."""
    rows = _read(docs)
    kept = kept_terms(rows, least)
    counts = settle(recount(rows, transducers(kept)))

    ends = kept.groupBy("lang").agg(
        F.min("ordinal").alias("first"), F.max("ordinal").alias("last"), F.count(F.lit(1)).alias("terms")
    )
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = settle(rows.select("lang", "source").distinct())
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    langs = settle(
        langs.join(ends, "lang", "left").select(
            "lang", F.ceil(F.col("sources") / TILE_SOURCES).alias("blocks"),
            "first", "last", F.coalesce("terms", F.lit(0)).alias("terms"),
        )
    )
    known = attach(groups.join(totals, ["lang", "source"], "left"), langs, {"lang": "lang"})
    total = F.coalesce("total", F.lit(0))
    absent = _share(F.lit(0), total, F.col("terms")).alias("absent")
    groups = settle(known.select("lang", "source", "blocks", "first", "last", "terms", total.alias("total"), absent))

    given = attach(counts, groups, {"lang": "lang", "source": "source"}, how="inner")
    shares = given.select("*", _share(F.col("n"), F.col("total"), F.col("terms")).alias("share"))
    pairs = _distances(groups, shares)

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n"))
    of_lang = totals.groupBy("lang").agg(F.sum("total").alias("total"))
    whole = attach(attach(whole, settle(of_lang), {"lang": "lang"}), langs, {"lang": "lang"})
    usual = whole.select(
        F.col("ordinal").alias("at"), _share(F.col("n"), F.col("total"), F.col("terms")).alias("usual")
    )
    surplus = attach(shares, settle(usual), {"ordinal": "at"}, how="inner")
    surplus = surplus.select("lang", "source", "ordinal", (F.col("share") - F.col("usual")).alias("value"))
    # a smaller ordinal is a smaller term
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    ranked = surplus.where("value > 0").withColumn("rank", F.row_number().over(best))
    ranked = settle(ranked.where(F.col("rank") <= top))
    terms = attach(ranked, kept.select("ordinal", "term"), {"ordinal": "ordinal"})

    furthest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(furthest))
    terms = terms.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )
    return pairs.unionByName(terms)
