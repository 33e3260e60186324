"""Scores of texts under a word n-gram model with Katz backoff.

The probability of a token after the ``order - 1`` tokens before it is its discounted relative
count where the n-gram was seen in training, else the backoff weight of that context times the
probability under the context without its earliest token, and so on down to the token alone;
that is its discounted relative count, or the mass left for unknown words, which are one class.
Discounts are Good-Turing's, one set per length of n-gram, from counts of counts over the whole
training part. Backoff weights make the probabilities after every context sum to one exactly.
Places before a text hold one begin token each.

A token goes to a bucket by its predecessor, so the n-grams of all lengths from two on, their
contexts and what these back off to are in one bucket, and only single words are counted elsewhere.
A part of the corpus sends a bucket its distinct n-grams and, for each, the documents it occurs in.

Every part names its words to every bucket, which would be most of what is sent. So the words are
counted first, and get short names, see :class:`Naming`: frequent words the smallest numbers, others
as many bits of their hashes as tell nearly all words apart. Words that these bits do not tell apart
are listed, so different hashes never share a name. The list is broadcast and has a bounded length.

1. A bucket adds up n-gram counts of every length and writes them, bucketed, with the occurrences.
   It asks for the counts of the words it has seen, and adds its own to them.
2. Word counts are added up per vocabulary bucket and sent back in the order they were asked for.
3. Every bucket computes backoff weights and probabilities from pairs up to the longest n-grams,
   each length from the one below, evaluates all occurrences and sends sums per document to where
   the document's sums meet. A family of a few buckets adds up its own sums before.

A predecessor with a large share of all tokens is spread over several buckets by the token before
it (in a pair model, by the token that follows). Contexts of two and more tokens stay whole; only
pairs of such a predecessor are in several buckets. Their counts are added up in step 2 with those
of the words, and the sums over all tokens after the predecessor between steps 2 and 3. There are
at most ``2 * SPREAD * MOST_SPREAD`` such predecessors. One context of two tokens is not split.

Counts stay in the written tables, see :func:`ngram_tables`.

Good-Turing's formula can leave no or negative discounts where counts of counts are few or
uneven; they are then put on a log-log line first, and if that fails (r - 1/2) / r is the discount.
A context whose counts all exceed the discounted ones gives up one part in its count plus one, so
no token ever has probability zero.

Results for unusual input: a null or empty text is the end token alone; a text of unknown words
scores as such; without training texts every token is unknown and has probability one; repeated rows
and ids are scored one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from goldkeep.llm.blobs import groups_for, pack, pack_arrays, text_size, unpack, unpack_arrays
from goldkeep.llm.words import WHITE_SPACE, mix, runs, slices, split, word_hashes
from goldkeep.shared import scratch_path, scratch_table, settle

#: Counts up to this one are discounted.
DISCOUNTED = 5
#: Bytes of text whose tokens meet in one bucket, about.
BUCKET_BYTES = 12 << 20
#: Most file groups of the bucketed table, and most tasks that add up buckets; beyond, several
#: buckets share one.
MOST_BUCKETS, MOST_TASKS = 4096, 20_000

#: Tokens of an n-gram.
ORDER = 3
#: Texts of a part of the corpus; more of them share more n-grams but need more memory.
PART_ROWS = 4000
#: A predecessor is spread from one part in ``SPREAD`` of a bucket's share on; shares of buckets
#: are taken as if there were no more than ``MOST_SPREAD``.
SPREAD, MOST_SPREAD = 4, 10_000
#: ``2 ** FAMILY`` consecutive buckets are evaluated by one task, one after another.
FAMILY = 2
#: Frequent words with names of their own, and others that their hashes' first bits do not tell
#: apart, about.
MOST_FREQUENT, MOST_ALIKE = 1 << 16, 1 << 14
#: Fewest and most bits of a hash in a name.
LEAST_BITS, MOST_BITS = 24, 62
#: Words that a task holds while it counts them.
HELD_WORDS = 1 << 21

#: Hashes that stand for a place before a text and the end of it.
BEGIN, END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xC2B2AE3D27D4EB4F)

_STORED = "kind string, bucket int, target long, blob binary, docs binary, n array<bigint>"
#: A family's number, from that of a bucket.
_FAMILY = f"shiftright(bucket, {FAMILY}) as family"


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, the ends included; first token and number of tokens of every text."""
    words = split(texts, WHITE_SPACE, lower=True)
    counts = words.counts + 1
    first = np.cumsum(counts) - counts
    token = np.full(int(counts.sum()), END, np.uint64)
    place = np.ones(len(token), bool)
    place[first + counts - 1] = False
    token[place] = word_hashes(words)
    return token, first, counts


def _before(token: np.ndarray, first: np.ndarray, begin) -> np.ndarray:
    """What stands before every token of its text."""
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first] = begin
    return before


def _counted(words: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words in order, and the sums of their counts."""
    distinct, place = np.unique(np.concatenate(words), return_inverse=True)
    sums = np.bincount(place, np.concatenate(counts), len(distinct))
    return distinct, sums.astype(np.int64)


def _count_words(ranges: int, bits: int, held: int):
    """Texts in; distinct words, counted, by range of hashes out; begin tokens are counted too.
    Words that agree in the first ``bits`` bits are in one range. A task holds about ``held``."""

    def ranged(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        first = words >> np.uint64(64 - bits)
        number = (first * np.uint64(ranges) >> np.uint64(bits)).astype(np.int64)
        used, at = np.unique(number, return_index=True)
        ends = np.append(at[1:], len(words))
        blobs = [
            pack_arrays(words=_steps(words[a:b]), count=n[a:b])
            for a, b in zip(at.tolist(), ends.tolist())
        ]
        columns = [pa.array(used), pa.array(blobs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["number", "blob"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = [], []
        for batch in slices(batches, PART_ROWS):
            token, _, own = _tokens(batch.column(0))
            for found in (_run_lengths(np.sort(token)), ([BEGIN], [len(own)])):
                words.append(np.array(found[0], np.uint64))
                counts.append(np.array(found[1], np.int64))
            if sum(map(len, words)) > held:
                one = _counted(words, counts)
                words, counts = [one[0]], [one[1]]
                if len(one[0]) > held // 2:
                    yield ranged(*one)
                    words, counts = [], []
        if words:
            yield ranged(*_counted(words, counts))

    return count


def _list_words(ranges: int, bits: int):
    """Counted words of a range in; the most frequent ones and all that share the first ``bits``
    bits with another out, the latter with the number of bits they share. A row without a word
    has the number of tokens."""
    most = 64 + 2 * MOST_FREQUENT // ranges

    def find(table: pa.Table) -> pa.Table:
        sent = [unpack_arrays(b) for b in table["blob"].to_pylist()]
        words, n = _counted([np.cumsum(s["words"]) for s in sent], [s["count"] for s in sent])
        differ = words[1:] ^ words[:-1]
        near = np.flatnonzero(differ >> np.uint64(64 - bits) == 0)
        length = np.array([64 - d.bit_length() for d in differ[near].tolist()], np.int32)
        shared = np.zeros(len(words), np.int32)
        np.maximum.at(shared, near, length)
        np.maximum.at(shared, near + 1, length)
        often = np.argsort(-n, kind="stable")[:most]
        listed = np.union1d(often, np.flatnonzero(shared))
        return pa.table(
            {
                "word": pa.array([None, *words[listed].view(np.int64).tolist()], pa.int64()),
                "n": np.append(n[words != BEGIN].sum(), n[listed]),
                "shared": np.append(np.int32(0), shared[listed]),
            }
        )

    return find


@dataclass
class Naming:
    """Short names of words, given as hashes: those of ``listed``, in order, have ``number``, all
    others the first ``bits`` bits of the hash after these. ``heads``, in order, are the frequent
    predecessors, ``parts`` says how many buckets each is spread over."""

    listed: np.ndarray
    number: np.ndarray
    bits: int
    heads: np.ndarray
    parts: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        names = (words >> np.uint64(64 - self.bits)) + np.uint64(len(self.listed))
        at, place = _find(words, self.listed)
        names[at] = self.number[place]
        return names

    @property
    def head_names(self) -> np.ndarray:
        return np.sort(self.of(self.heads))


def name_words(texts: DataFrame, size: int, buckets: int) -> Naming:
    """Names of all words of ``texts``, which have ``size`` bytes, and their frequent predecessors."""
    least = min(MOST_BITS, max(LEAST_BITS, size.bit_length() - 2))
    counted = texts.mapInArrow(_count_words(buckets, LEAST_BITS, HELD_WORDS), "number long, blob binary")
    found = settle(
        counted.groupBy("number").applyInArrow(
            _list_words(buckets, least), "word long, n long, shared int"
        )
    )
    words = found.where("word is not null")
    total = found.where("word is null").agg(F.sum("n")).first()[0] or 0
    alike = dict(words.where(F.col("shared") >= least).groupBy("shared").count().collect())
    bits = next(
        (
            b
            for b in range(least, MOST_BITS)
            if sum(n for shared, n in alike.items() if shared >= b) <= MOST_ALIKE
        ),
        MOST_BITS,
    )
    # quarters of doublings of counts, from the highest down, as long as there are not too many words
    step = F.floor(F.log2("n") * 4)
    steps = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)
    fits = np.cumsum([n for _, n in steps]) <= MOST_FREQUENT
    lowest = min([s for (s, _), fit in zip(steps, fits) if fit], default=1 << 30)
    shares = SPREAD * min(buckets, MOST_SPREAD)
    heavy = F.col("n") * (2 * shares) >= total
    listed = words.where((step >= lowest) | (F.col("shared") >= bits) | heavy).toArrow()
    hashes = listed["word"].to_numpy().view(np.uint64)
    n = listed["n"].to_numpy()
    order = np.argsort(hashes)
    hashes, n = hashes[order], n[order]
    number = np.empty(len(n), np.uint64)
    number[np.argsort(-n, kind="stable")] = np.arange(len(n), dtype=np.uint64)
    # nothing follows an end
    often = (n * (2 * shares) >= total) & (hashes != END)
    return Naming(hashes, number, bits, hashes[often], 1 + n[often] * shares // max(1, total))


def _grouped(columns: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by columns of numbers below ``size``, the first column first, and which
    rows of that order begin a group of equal ones."""
    bits = max(1, (size - 1).bit_length())
    if bits * len(columns) < 64:
        key = np.zeros(len(columns[0]), np.int64)
        for column in columns:
            key = key << bits | column
        order = np.argsort(key)
        return order, _begins([key[order]])
    order = np.lexsort(columns[::-1])
    return order, _begins([c[order] for c in columns])


def _begins(columns: list[np.ndarray]) -> np.ndarray:
    """Where a value of any column differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _sizes(new: np.ndarray) -> np.ndarray:
    return np.diff(np.flatnonzero(new), append=len(new))


def _pack_grams(names: np.ndarray, grams: np.ndarray, train: np.ndarray) -> bytes:
    """Ordered n-grams of a part for one bucket: a context as one number and its size."""
    used, place = np.unique(grams, return_inverse=True)
    place = place.reshape(grams.shape).astype(np.int32)
    arrays = {"words": _steps(names[used]), "last": place[-1], "train": train.astype(np.int32)}
    for level in range(len(grams) - 1):
        new = _begins(list(place[: level + 1]))
        arrays[f"context{level}"] = place[level][new]
        arrays[f"size{level}"] = _sizes(new).astype(np.int32)
    return pack_arrays(**arrays)


def _deal(order: int, buckets: int, naming):
    """Texts in, their n-grams by bucket out; ``target`` is the part of the corpus. The ids of a
    part travel to a bucket with a negative number."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for batch in slices(batches, PART_ROWS):
            token, first, counts = _tokens(batch.column(1))
            learnt = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            words, code = np.unique(np.append(token, BEGIN), return_inverse=True)
            names = naming.value.of(words)
            by = np.argsort(names)
            place = np.empty(len(by), np.int32)
            place[by] = np.arange(len(by), dtype=np.int32)
            words, names, code = words[by], names[by], place[code]
            code, begin = code[:-1], code[-1]
            del token
            # from the predecessor to the earliest token, then the token itself
            columns = [_before(code, first, begin)]
            while len(columns) < order - 1:
                columns.append(_before(columns[-1], first, begin))
            columns.append(code)
            by, new = _grouped(columns, len(words))
            text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[by]
            at = np.flatnonzero(new)
            times = _sizes(new)
            train = np.add.reduceat(learnt[text], at, dtype=np.int64)
            grams = np.stack([c[by[at]] for c in columns])
            del columns, code, by, new
            bucket = _bucket(words[grams[0]], words[grams[1]], buckets, naming.value)
            by = np.argsort(bucket, kind="stable")
            times, train, bucket, grams = times[by], train[by], bucket[by], grams[:, by]
            text = text[runs(at[by], times)]
            place = np.cumsum(times) - times
            used, first = np.unique(bucket, return_index=True)
            ends = np.append(first[1:], len(bucket))
            blobs, docs = [], []
            for a, b in zip(first.tolist(), ends.tolist()):
                blobs.append(_pack_grams(names, grams[:, a:b], train[a:b]))
                docs.append(
                    pack_arrays(
                        times=times[a:b].astype(np.int32),
                        docs=text[place[a] : place[b - 1] + times[b - 1]],
                    )
                )
            ids = pa.table({"id": batch.column(0), "learnt": learnt, "n_tokens": counts})
            numbers = np.append(used, -1 - (part + (part >> 32)) % buckets).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers),
                    pa.array(np.full(len(numbers), part)),
                    pa.array([*blobs, pack(ids)], pa.binary()),
                    pa.array([*docs, None], pa.binary()),
                ],
                ["bucket", "target", "blob", "docs"],
            )
            part += 1

    return deal


def _bucket(head: np.ndarray, word: np.ndarray, buckets: int, naming: Naming) -> np.ndarray:
    """Bucket of a predecessor, or one of several, by another word, for a frequent one."""
    bucket = ((head >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    at, place = _find(head, naming.heads)
    bucket[at] += (mix(word[at]) % naming.parts[place].astype(np.uint64)).astype(np.int64)
    return bucket % buckets


def _find(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``values`` are in the table ``ordered``, and where there."""
    place = np.searchsorted(ordered, values)
    found = place < len(ordered)
    found[found] = ordered[place[found]] == values[found]
    at = np.flatnonzero(found)
    return at, place[at]


def _steps(ordered: np.ndarray) -> np.ndarray:
    """Ordered numbers as differences, which have fewer bits; ``np.cumsum`` is the inverse."""
    return np.diff(ordered, prepend=np.uint64(0))


def _run_lengths(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(new)
    return values[at], np.diff(at, append=len(values))


def _counts_of_counts(counts: np.ndarray) -> np.ndarray:
    """How many of ``counts`` are 0, 1, 2, ... up to one above the discounted ones."""
    return np.bincount(counts[counts <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["kind", "bucket", "target", "blob", "docs", "n"]
    full = [row + (None,) * (len(names) - len(row)) for row in rows]
    columns = zip(*full) if full else [[] for _ in names]
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def _statistics_row(number: int, level: int, n: np.ndarray) -> tuple:
    return ("statistics", number, level, None, None, n.tolist())


def _merged(sent: list[dict], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Names of words of all parts, and their n-grams as columns of places of words with train counts."""
    words, place = np.unique(
        np.concatenate([np.cumsum(s["words"]) for s in sent]), return_inverse=True
    )
    ends = np.cumsum([len(s["words"]) for s in sent])
    places = [p.astype(np.int32) for p in np.split(place, ends[:-1])]
    columns = [
        np.concatenate(
            [np.repeat(p[s[f"context{j}"]], s[f"size{j}"]) for p, s in zip(places, sent)]
        )
        for j in range(order - 1)
    ]
    columns.append(np.concatenate([p[s["last"]] for p, s in zip(places, sent)]))
    return words, columns, np.concatenate([s["train"] for s in sent])


def _add_grams(order: int, vocabularies: int, naming):
    """All n-grams of a bucket in; their counts, their occurrences, what the bucket asks of the
    vocabulary, and counts of counts out."""

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        parts, blobs, docs = (table[c].to_pylist() for c in ("target", "blob", "docs"))
        if bucket < 0:
            return _rows([("ids", bucket, part, blob) for part, blob in zip(parts, blobs)])
        sent = [unpack_arrays(b) for b in blobs]
        words, columns, count = _merged(sent, order)
        sizes = [len(s["last"]) for s in sent]
        del sent, blobs
        by, new = _grouped(columns, len(words))
        gram = np.empty(len(by), np.int32)
        gram[by] = np.cumsum(new) - 1
        rows, start = [], 0
        for part, size, own in zip(parts, sizes, docs):
            # a part sends its n-grams in the order they have here
            mine = np.diff(gram[start : start + size], prepend=np.int32(0))
            rows.append(("occurrences", bucket, part, pack_arrays(gram=mine), own))
            start += size
        arrays = {}
        for level in range(order, 1, -1):
            at = np.flatnonzero(new)
            count = np.add.reduceat(count[by], at, dtype=np.int64)
            columns = [c[by[at]] for c in columns]
            arrays[f"count{level}"] = count
            arrays[f"size{level}"] = _sizes(_begins(columns[:-1])).astype(np.int32)
            if level > 2:
                rows.append(_statistics_row(bucket, level, _counts_of_counts(count)))
                # the n-grams without their earliest token
                del columns[-2]
                by, new = _grouped(columns, len(words))
                lower = np.empty(len(by), np.int32)
                lower[by] = np.cumsum(new) - 1
                arrays[f"lower{level}"] = lower
        head, last = words[columns[0]], columns[-1]
        # words and spread pairs in the order of the questions, so that answers need no names
        used = np.unique(last)
        target, by = _targets(words[used], vocabularies)
        asked = words[used][by]
        rank = np.empty(len(words), np.int32)
        rank[used[by]] = np.arange(len(used))
        arrays["lower2"] = rank[last]
        own = np.bincount(rank[last], weights=count, minlength=len(used)).astype(np.int64)
        spread, _ = _find(head, naming.value.head_names)
        rows.append(_statistics_row(bucket, 2, _counts_of_counts(np.delete(count, spread))))
        names = mix(mix(head[spread]) * _PAIR + words[last[spread]])
        pair_target, by = _targets(names, vocabularies)
        arrays["spread"] = spread[by].astype(np.int32)
        names, pair_count = names[by], count[spread[by]]
        arrays["heads"] = _steps(_run_lengths(head)[0])
        rows.append(("grams", bucket, 0, pack_arrays(**arrays)))
        for number in np.union1d(target, pair_target).tolist():
            a, b = np.searchsorted(target, [number, number + 1])
            c, d = np.searchsorted(pair_target, [number, number + 1])
            blob = pack_arrays(
                words=_steps(asked[a:b]),
                words_count=own[a:b],
                pairs=_steps(names[c:d]),
                pairs_count=pair_count[c:d],
            )
            rows.append(("questions", bucket, number, blob))
        return _rows(rows)

    return add


#: Odd, so that different predecessors give different names to pairs.
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _targets(names: np.ndarray, vocabularies: int) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary buckets of names, in order, and the order of the names by them."""
    target = (mix(names) % np.uint64(vocabularies)).astype(np.int64)
    by = np.lexsort((names, target))
    return target[by], by


def _add_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """All questions to a vocabulary bucket in; counts of words and of spread pairs, answers and
    counts of counts out. The first that asks for a pair is told to count it for its predecessor."""
    number, blobs = key[0].as_py(), table["blob"].to_pylist()
    sent = [unpack_arrays(b) for b in blobs]
    totals, told, owner = {}, {}, {}
    for what in ("words", "pairs"):
        asked = np.concatenate([np.cumsum(s[what]) for s in sent])
        own = np.concatenate([s[f"{what}_count"] for s in sent])
        names, first, place = np.unique(asked, return_index=True, return_inverse=True)
        count = np.bincount(place, weights=own, minlength=len(names)).astype(np.int64)
        totals[what], told[what] = (names, count), count[place]
        owner[what] = np.zeros(len(asked), np.uint8)
        owner[what][first] = 1
    words, count = totals["words"]
    known = [(count > 0).sum(), count.sum()]
    rows = [
        ("words", number, 0, pack_arrays(words=_steps(words), count=count)),
        _statistics_row(number, 1, np.append(_counts_of_counts(count), known).astype(np.int64)),
        _statistics_row(number, 2, _counts_of_counts(totals["pairs"][1])),
    ]
    at = {"words": 0, "pairs": 0}
    for bucket, one in zip(table["bucket"].to_pylist(), sent):
        part = {what: slice(a, a + len(one[what])) for what, a in at.items()}
        answer = pack_arrays(
            count=told["words"][part["words"]],
            pairs=told["pairs"][part["pairs"]],
            owner=owner["pairs"][part["pairs"]],
        )
        rows.append(("answers", bucket, number, answer))
        at = {what: own.stop for what, own in part.items()}
    return _rows(rows)


def good_turing(n: np.ndarray) -> np.ndarray:
    """What a count of 0, 1, 2, ... is multiplied by; the last value stands for all above."""
    r = np.arange(1, DISCOUNTED + 1)
    for counts in (n.astype(float), _on_a_line(n)):
        with np.errstate(divide="ignore", invalid="ignore"):
            top = (DISCOUNTED + 1) * counts[DISCOUNTED + 1] / counts[1]
            d = ((r + 1) * counts[r + 1] / (r * counts[r]) - top) / (1 - top)
        if ((d > 0) & (d < 1)).all():
            return np.concatenate([[0.0], d, [1.0]])
    return np.concatenate([[0.0], (r - 0.5) / r, [1.0]])


def _on_a_line(n: np.ndarray) -> np.ndarray:
    """Counts of counts put on a line of their logarithms, as simple Good-Turing does."""
    r = np.flatnonzero(n[1:]) + 1
    if len(r) < 2:
        return np.zeros(len(n))
    slope, level = np.polyfit(np.log(r), np.log(n[r]), 1)
    return np.append(0.0, np.exp(level + slope * np.log(np.arange(1, len(n)))))


@dataclass
class Model:
    """What all buckets need to know: discounts of n-grams by their length, tokens and distinct
    tokens in training, and the probability of the class of unknown words."""

    discounts: dict[int, np.ndarray]
    tokens: int
    types: int
    unknown: float = 1.0
    known_share: float = 1.0

    @classmethod
    def of(cls, counts: dict[int, np.ndarray], types: int, tokens: int) -> Model:
        """From counts of counts by length."""
        model = cls({k: good_turing(n) for k, n in counts.items()}, tokens, types)
        r = np.arange(1, DISCOUNTED + 1)
        if tokens:
            freed = float((counts[1][r] * r * (1 - model.discounts[1][r])).sum())
            model.unknown = freed / tokens if freed else 1 / (tokens + 1)
            model.known_share = 1.0 if freed else tokens / (tokens + 1)
        return model

    def discounted(self, level: int, count: np.ndarray) -> np.ndarray:
        return self.discounts[level][np.minimum(count, DISCOUNTED + 1)] * count

    def word_probability(self, count: np.ndarray) -> np.ndarray:
        known = self.known_share * self.discounted(1, count) / max(1, self.tokens)
        return np.where(count > 0, known, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        """Log probability by add-one counts."""
        return np.log10((count + 1) / (self.tokens + self.types + 1))

    def context_sums(
        self, level: int, count: np.ndarray, context: np.ndarray, contexts: int, lower: np.ndarray
    ) -> np.ndarray:
        """Of each context: tokens after it in training, discounted ones, and the probability
        of those tokens under the shorter context. ``context`` numbers that of an n-gram,
        ``lower`` is the probability under the shorter one."""
        parts = (count, self.discounted(level, count), np.where(count > 0, lower, 0))
        return np.stack([np.bincount(context, part, minlength=contexts) for part in parts])

    def probability(
        self, level: int, count: np.ndarray, context: np.ndarray, sums: np.ndarray, lower: np.ndarray
    ) -> np.ndarray:
        """Probability of the last token of each n-gram, given the sums of all contexts."""
        total, discounted, seen_lower = sums
        left = 1 - discounted / np.maximum(total, 1)
        # nothing was discounted after this context
        full = (left < 1e-12) & (total > 0)
        share = np.where(full, total / (total + 1), 1.0) / np.maximum(total, 1)
        left = np.where(full, 1 / (total + 1), left)
        backoff = np.where(total > 0, left / np.maximum(1 - seen_lower, 1e-300), 1.0)
        kept = self.discounted(level, count) * share[context]
        return np.where(count > 0, kept, backoff[context] * lower)


class _Bucket:
    """N-grams of a bucket with the answers it got."""

    def __init__(self, blob: bytes, answers: pa.Table):
        told = [unpack_arrays(b) for b in answers.sort_by("target")["blob"].to_pylist()]
        self.grams = unpack_arrays(blob)
        self.heads = np.cumsum(self.grams["heads"])
        self.word_count = np.concatenate([t["count"] for t in told])
        self.spread_count = np.concatenate([t["pairs"] for t in told])
        self.owner = np.concatenate([t["owner"] for t in told]).astype(bool)

    def _level(self, level: int, below: np.ndarray):
        size = self.grams[f"size{level}"]
        count = self.grams[f"count{level}"]
        if level == 2:
            count[self.grams["spread"]] = self.spread_count
        return count, np.repeat(np.arange(len(size)), size), len(size), below[self.grams[f"lower{level}"]]

    def spread_sums(self, model: Model, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Frequent predecessors of the bucket and its part of their sums."""
        count, head, heads, lower = self._level(2, model.word_probability(self.word_count))
        count[self.grams["spread"]] = np.where(self.owner, self.spread_count, 0)
        at, _ = _find(self.heads, frequent)
        return self.heads[at], model.context_sums(2, count, head, heads, lower)[:, at]

    def scores(self, model: Model, order: int, frequent: np.ndarray, over_all: np.ndarray):
        """Probability of each n-gram and how often its last token was seen in training."""
        below, word = model.word_probability(self.word_count), self.word_count
        for level in range(2, order + 1):
            count, context, contexts, lower = self._level(level, below)
            sums = model.context_sums(level, count, context, contexts, lower)
            if level == 2:
                at, place = _find(self.heads, frequent)
                sums[:, at] = over_all[:, place]
            below = model.probability(level, count, context, sums, lower)
            word = word[self.grams[f"lower{level}"]]
        return below, word


def _family(stored: pa.Table, answers: pa.Table) -> Iterator[tuple[int, _Bucket]]:
    """The buckets of a family, one after another."""
    columns = (stored[c].to_pylist() for c in ("kind", "bucket"))
    for row, (kind, bucket) in enumerate(zip(*columns)):
        if kind == "grams":
            told = answers.filter(pc.equal(answers["bucket"], bucket))
            yield bucket, _Bucket(stored["blob"][row].as_py(), told)


def _spread_sums(model, naming):
    """N-grams and answers of a family in; its part of the sums of frequent heads out."""

    def add(stored: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["head", "total", "discounted", "alone"]
        heads, sums = [np.zeros(0, np.uint64)], [np.zeros((3, 0))]
        for _, bucket in _family(stored, answers):
            head, own = bucket.spread_sums(model.value, naming.value.head_names)
            heads.append(head)
            sums.append(own)
        head = np.concatenate(heads).view(np.int64)
        return pa.table([pa.array(head), *map(pa.array, np.concatenate(sums, 1))], names=names)

    return add


def _evaluate(order: int, model, spread):
    """Counts, occurrences and answers of a family in; sums per document, by part, out."""

    def evaluate(stored: pa.Table, answers: pa.Table) -> pa.Table:
        scored = {}
        for number, bucket in _family(stored, answers):
            probability, count = bucket.scores(model.value, order, *spread.value)
            scored[number] = np.log10(probability), model.value.base(count), count > 0
        parts = defaultdict(list)
        columns = (stored[c].to_pylist() for c in ("kind", "bucket", "target"))
        for row, (kind, bucket, part) in enumerate(zip(*columns)):
            if kind == "occurrences":
                parts[part].append((row, bucket))
        out = []
        for part, sent in parts.items():
            sums = []
            for row, bucket in sent:
                own = unpack_arrays(stored["docs"][row].as_py())
                gram = unpack_arrays(stored["blob"][row].as_py())["gram"]
                gram = np.repeat(np.cumsum(gram), own["times"])
                sums.append([np.bincount(own["docs"], values[gram]) for values in scored[bucket]])
            score, base, known = (_total(each) for each in zip(*sums))
            blob = pack_arrays(score=score, base=base, known=known.astype(np.int32))
            out.append(("sums", 0, part, blob))
        return _rows(out)

    return evaluate


def _total(arrays: tuple[np.ndarray, ...]) -> np.ndarray:
    """Sum of arrays of several lengths, missing numbers being 0."""
    total = np.zeros(max(map(len, arrays)))
    for values in arrays:
        total[: len(values)] += values
    return total


def _finish(id_type: pa.DataType):
    """Ids and sums of a part of the corpus in, scored documents out."""

    def finish(ids: pa.Table, sums: pa.Table) -> pa.Table:
        docs = pa.concat_tables([unpack(b) for b in ids["blob"].to_pylist()])
        n = docs.num_rows
        total = {"score": np.zeros(n), "base": np.zeros(n), "known": np.zeros(n, np.int64)}
        for blob in sums["blob"].to_pylist():
            for name, values in unpack_arrays(blob).items():
                total[name][: len(values)] += values
        return pa.table(
            {
                "id": docs["id"].cast(id_type),
                "learnt": docs["learnt"],
                "n_tokens": docs["n_tokens"],
                "n_known": total["known"],
                "base_score": total["base"],
                "score": total["score"],
            }
        )

    return finish


def _statistics(rows: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Sums of the numbers of all buckets by level, added up by Spark."""
    sums = [F.sum(F.get("n", F.lit(i))) for i in range(width)]
    found = rows.where("kind = 'statistics'").groupBy("target").agg(*sums).collect()
    return {r[0]: np.array([n or 0 for n in r[1:]], np.int64) for r in found}


def ngram_tables(
    docs: DataFrame,
    learnt: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: int = ORDER,
):
    """The written tables of n-grams (bucketed by predecessor) and of words, and the words' names."""
    if order < 2:
        raise ValueError("an n-gram has two tokens at least")
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.coalesce(learnt, F.lit(False)).alias("learnt"),
    )
    size = text_size(docs, text_column)
    buckets = groups_for(size, BUCKET_BYTES)
    naming = spark.sparkContext.broadcast(name_words(rows.select("text"), size, buckets))
    # a task that is run again numbers its rows alike
    rows = rows.sortWithinPartitions("id", F.xxhash64("text"), "learnt")
    dealt = rows.mapInArrow(
        _deal(order, buckets, naming), "bucket int, target long, blob binary, docs binary"
    )
    # one bucket per task
    dealt = dealt.repartitionById(min(buckets, MOST_TASKS), "bucket")
    added = dealt.groupBy("bucket").applyInArrow(_add_grams(order, buckets, naming), _STORED)
    # bucketed by family, so that the answers can come to the n-grams without moving them
    name = scratch_table("grams")
    families = groups_for(buckets, 1 << FAMILY)
    # what is in the blobs is compressed already
    written = added.selectExpr("*", _FAMILY).write.option("compression", "none")
    # more file groups than families, so that few share one
    written.bucketBy(min(4 * families, MOST_BUCKETS), "family").saveAsTable(name)
    grams = spark.table(name)
    path = scratch_path(spark, "words")
    questions = grams.where("kind = 'questions'").select("target", "bucket", "blob")
    counted = questions.groupBy("target").applyInArrow(_add_words, _STORED)
    counted.write.option("compression", "none").parquet(path)
    return grams, spark.read.schema(_STORED).parquet(path), naming


def score_texts(
    docs: DataFrame,
    learnt: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: int = ORDER,
) -> DataFrame:
    """``id``, ``learnt``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of every text; the model of n-grams of ``order`` tokens (two at least) learns from
    the rows of which ``learnt`` is true."""
    spark = docs.sparkSession
    grams, words, naming = ngram_tables(docs, learnt, id_column, text_column, order)
    width = DISCOUNTED + 4
    of = _statistics(grams.select("kind", "target", "n").union(words.select("kind", "target", "n")), width)
    of = {level: of.get(level, np.zeros(width, np.int64)) for level in range(1, order + 1)}
    types, tokens = (int(n) for n in of[1][-2:])
    model = Model.of({level: n[: DISCOUNTED + 2] for level, n in of.items()}, types, tokens)
    sent = spark.sparkContext.broadcast(model)
    answers = words.where("kind = 'answers'").selectExpr(_FAMILY, "bucket", "target", "blob")
    answers = answers.groupBy("family")
    parts = (
        grams.where("kind = 'grams'")
        .select("family", "kind", "bucket", "blob")
        .groupBy("family")
        .cogroup(answers)
        .applyInArrow(
            _spread_sums(sent, naming), "head long, total double, discounted double, alone double"
        )
    )
    added = parts.groupBy("head").agg(*[F.sum(c).alias(c) for c in ("total", "discounted", "alone")])
    # not more than there are frequent predecessors
    found = sorted(added.collect(), key=lambda r: r["head"] % (1 << 64))
    head = np.array([r["head"] for r in found], np.int64).view(np.uint64)
    over_all = np.array([r[1:] for r in found], float).reshape(-1, 3).T
    spread = spark.sparkContext.broadcast((head, over_all))
    sums = (
        grams.where("kind in ('grams', 'occurrences')")
        .select("family", "kind", "bucket", "target", "blob", "docs")
        .groupBy("family")
        .cogroup(answers)
        .applyInArrow(_evaluate(order, sent, spread), _STORED)
    )
    ids = grams.where("kind = 'ids'")
    kind = docs.schema[id_column].dataType
    scored = ids.groupBy("target").cogroup(sums.groupBy("target")).applyInArrow(
        _finish(to_arrow_type(kind)),
        f"id {kind.simpleString()}, learnt boolean, n_tokens long, n_known long, "
        "base_score double, score double",
    )
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long"))
