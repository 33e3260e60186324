"""Operators against their plain versions, on odd and on empty input."""

import zlib
from types import SimpleNamespace

import numpy as np
import plain
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import public_tokenizers
from goldkeep.llm import (
    blobs,
    chat,
    components,
    decontaminate,
    jaccard,
    katz,
    lines,
    neighbours,
    packing,
    sharding,
    substrings,
    toxicity,
    words,
)

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i * i % 977}" for i in range(30_000))
PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"

#: Null and empty texts, white space alone, a very long text, copies, repeated rows and ids, a
#: null id, marks inside texts.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, LONG),
    (5, PASSAGE),
    (6, f"before it {PASSAGE} and after"),
    (6, f"before it {PASSAGE} and after"),
    (7, "Two words"),
    (7, PASSAGE),
    (8, "two WORDS"),
    (9, "é ñ ü " * 20),
    (10, "é ñ ü " * 20 + "more"),
    (11, "a\nb\nc\nd\ne"),
    (12, "x\na\nb\nc\nd\ny\na\nb\nc"),
    (13, "<|im_end|>&amp;<|"),
    (None, PASSAGE),
    (None, LONG + " tail"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The rows above with columns named like those the operators add."""
    rows = [(i, t, "x", 1, 2.5, "k") for i, t in ODD]
    schema = "doc_id long, text string, n_words string, _chunk int, toxicity double, kept_text string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


TEXTS = st.lists(st.none() | st.text("abAB \n\té\x0b.,'0", max_size=40), max_size=8)


def odd_rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# --- words -----------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words_equal_the_pattern(texts):
    for separators, lower, find in (
        (words.WHITE_SPACE, False, plain.spaced),
        (words.NOT_ALPHANUMERIC, True, plain.alphanumeric),
    ):
        found = words.split(pa.array(texts, pa.string()), separators, lower)
        assert found.strings().to_pylist() == [w for t in texts for w in find(t)]
        assert found.counts.tolist() == [len(find(t)) for t in texts]


def test_hashes_know_words_in_any_batch():
    one = words.split(pa.array(["a bb a", "ba ab"]), words.WHITE_SPACE)
    two = words.split(pa.array(["x" * 3_000_000 + " bb"]), words.WHITE_SPACE)
    a, b = words.word_hashes(one), words.word_hashes(two)
    assert a[0] == a[2] and len(set(a)) == 4 and a[1] == b[1]


def test_equal_bytes():
    data = np.frombuffer(b"abcabd", np.uint8)
    at = np.array([0, 0, 0, 2]), np.array([2, 3, 0, 3]), np.array([3, 3, 4, 3]), np.array([5, 6, 4, 5])
    assert words.equal_bytes(data, at[0], at[1], data, at[2], at[3]).tolist() == [True, False, True, False]


# --- decontamination -------------------------------------------------------------------

ITEMS = [(1, "One two, three four five six seven eight nine TEN eleven"), (2, "two words"),
         (3, None), (4, ""), (None, "é ñ"), (2, "two words"), (5, "never seen words in any document at all now yes")]


@pytest.mark.parametrize("block", [32 << 20, 300])
def test_decontaminate(spark, odd, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.decontaminate(odd, items)
    assert set(odd.columns) <= set(found.columns)
    got = found.collect()
    assert len(got) == len(odd_rows(odd))
    for r in got:
        want = plain.hits(r.text, ITEMS)
        assert (sorted(r.hit_words), sorted(r.found_items)) == want
        assert r.n_words == len(plain.alphanumeric(r.text))


def test_decontaminate_empty(spark, odd, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontaminate(empty, items).count() == 0
    none = decontaminate.decontaminate(odd, items.limit(0)).collect()
    assert len(none) == odd.count() and not any(r.hit_words or r.found_items for r in none)


# --- toxicity --------------------------------------------------------------------------


def test_toxicity_of_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = F.crc32(F.col("_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(docs, labels, ~held)
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").withColumn("_id", F.col("doc_id"))
    rows = scored.where(held).select("toxic", "toxicity").collect()
    toxic = [r.toxicity for r in rows if r.toxic == 1]
    clean = [r.toxicity for r in rows if r.toxic == 0]
    above = np.mean([t > c for t in toxic for c in clean])
    # two hundred toxic texts are few to learn from; with a thousand all are found
    assert above > 0.9
    assert np.mean([t >= 0.7 for t in toxic]) > 0.5 and np.mean([c >= 0.7 for c in clean]) < 0.01


@pytest.mark.parametrize("times", [1, 9])
def test_toxicity_does_not_depend_on_the_share_of_labels(monkeypatch, times):
    monkeypatch.setattr(toxicity, "FEATURES", 1 << 12)
    plain_text, marked = "an ordinary day at the harbour", "an ordinary day at the villainous harbour"
    clean = [plain_text] * 180 + [marked] * 20
    texts = [marked] * 160 + [plain_text] * 40 + clean * times
    batch = pa.record_batch({"text": texts, "label": [1] * 200 + [0] * 200 * times})
    blobs = [b for out in toxicity._features(iter([batch])) for b in out.column(0).to_pylist()]
    with_mark, without = toxicity.fit(blobs).score(pa.array([marked, plain_text]))
    # one text in ten is toxic: Bayes on 80 % against 10 %, and 20 % against 90 %
    assert with_mark == pytest.approx(0.08 / 0.17, abs=0.05)
    assert without == pytest.approx(0.02 / 0.83, abs=0.02)


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1), (4, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    scored = toxicity.score_toxicity(odd, model)
    assert scored.columns.count("toxicity") == 1
    rows = scored.collect()
    assert len(rows) == odd.count() and all(0 <= r.toxicity <= 1 for r in rows)
    # one class alone, or nothing: the share of the class
    for learnt in (labels.where("toxic = 0"), labels.limit(0)):
        single = toxicity.score_toxicity(odd, toxicity.train(odd, learnt)).collect()
        assert {round(r.toxicity, 3) for r in single} == {0.0}
    assert toxicity.score_toxicity(empty, model).count() == 0


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    """Neither rows of one id nor long texts make the sample larger."""
    docs = [(1, f"copy {i % 2}") for i in range(900)] + [(i, "x" * 50) for i in range(2, 40)] + [(40, "y" * 5000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 41)], "doc_id long, toxic int")
    fitted = []
    monkeypatch.setattr(toxicity, "fit", lambda blobs, prior: fitted.extend(toxicity._texts(blobs)))
    toxicity.train(frame, labels, sample=15, sample_bytes=1000)
    assert 10 <= len(fitted) <= 30 and max(len(g) for g, _ in fitted) < 200
    fitted.clear()
    toxicity.train(frame, labels)
    assert len(fitted) == 2 + 38 + 1


def test_ratios_and_weights_equal_a_plain_fit(spark):
    """Characters, counts, ratios and the regression written out over dictionaries."""
    rng = np.random.default_rng(3)
    words_ = ["calm", "sea", "ÉTÉ", "naïve", "vile", "日本語", "scum", "tea"]
    texts = [" ".join(rng.choice(words_[:4] + words_[7:] if i % 3 else words_[3:7], 6)) for i in range(60)]
    labels = [int(i % 3 == 0) for i in range(60)]
    batch = pa.record_batch({"text": texts, "label": labels})
    model = toxicity.fit([b for out in toxicity._features(iter([batch])) for b in out.column(0).to_pylist()])

    def grams(text):
        lower = " " + "".join(c.lower() if c.isascii() else c for c in text) + " "
        return {lower[i : i + n] for n in toxicity.ORDERS for i in range(len(lower) - n + 1)}

    own = [grams(t) for t in texts]
    seen = [{}, {}]
    for g, y in zip(own, labels):
        for x in g:
            seen[y][x] = seen[y].get(x, 0) + 1
    total = [sum(c.values()) + toxicity.FEATURES for c in seen]
    ratio = {}
    for x in set(seen[0]) | set(seen[1]):
        clean, toxic = seen[0].get(x, 0), seen[1].get(x, 0)
        r = np.log((toxic + 1) / total[1]) - np.log((clean + 1) / total[0])
        if toxic + clean >= toxicity.MIN_TEXTS and abs(r) >= toxicity.MIN_RATIO:
            ratio[x] = r
    names = sorted(ratio)
    x = np.array([[ratio[n] / np.sqrt(len(g)) if n in g else 0 for n in names] for g in own])
    y = np.array(labels, float)
    weight = np.where(y == 1, toxicity.PRIOR / y.mean(), (1 - toxicity.PRIOR) / (1 - y.mean()))

    def pulled(w, b):
        return weight * (1 / (1 + np.exp(-(x @ w + b))) - y)

    # weights of the fit, by the plain names of the n-grams, are where the gradient vanishes
    at = {n: int(g) for n in names for g in [single_hash(n)]}
    w = np.array([model.weights[at[n]] / ratio[n] for n in names])
    score = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    assert model.score(pa.array(texts)) == pytest.approx(score, abs=1e-6)
    residual = pulled(w, model.intercept)
    assert np.abs(x.T @ residual / len(y)).max() < 1e-3 and abs(residual.mean()) < 1e-3


def single_hash(gram):
    """The hash that the operator gives one n-gram, from a text that has it and no blanks of its own."""
    text = np.frombuffer(gram.encode("utf-32-le"), np.uint32)
    h = np.uint32(len(text))
    with np.errstate(over="ignore"):
        for c in text:
            h = np.uint32(h * np.uint32(0x01000193)) ^ c
        h ^= h >> np.uint32(15)
        h = np.uint32(h * np.uint32(0x2C1B3C6D))
        h ^= h >> np.uint32(12)
    return h & np.uint32(toxicity.FEATURES - 1)


# --- chat ------------------------------------------------------------------------------

TURNS = [(1, 0, "system", "be & kind"), (1, 2, "assistant", "b"), (1, 1, "user", "a<|im_sep|>"),
         (1, 3, "assistant", None), (1, 4, "assistant", "c<"), (1, 4, "assistant", "c<"), (2, None, None, ""),
         (2, 1, "a\nb", "&lt;|<<|&#10;&amp;"), (None, 1, "assistant", "no id\n"), (3, 1, "user", "x" * 200_000)]


def read_turns(df):
    shown = df.select(
        "conv_id",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        "formatted",
    )
    return {r.conv_id: r for r in shown.collect()}


def test_chat_reads_back(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = read_turns(chat.format_conversations(turns.withColumn("turns", F.lit(1))))
    assert set(got) == {1, 2, 3, None}
    for conv, row in got.items():
        own = sorted(
            ((t is not None, t or 0, r or "", x or "") for c, t, r, x in TURNS if c == conv)
        )
        assert [(t.role, t.text) for t in row.turns] == [(r, x) for *_, r, x in own]
        assert row.loss == "".join(x for *_, r, x in own if r == "assistant")
    assert got[1].formatted.count(chat.START) == 3  # neighbours of one role share a block


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "&<|\n"]), st.text("<|im_end>&#10;lt\nsep", max_size=25)), min_size=1, max_size=6))
def test_chat_round_trip(spark, said):
    rows = [(1, n, r, t) for n, (r, t) in enumerate(said)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (row,) = read_turns(chat.format_conversations(turns)).values()
    assert [(t.role, t.text) for t in row.turns] == said


def test_chat_empty(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(turns).count() == 0


# --- lines -----------------------------------------------------------------------------


def test_lines(odd, empty, join_path):
    rows = odd_rows(odd)
    want = plain.without_repeated_lines(rows)
    got = lines.drop_repeated_lines(odd)
    assert got.columns.count("kept_text") == 1 and "_chunk" in got.columns
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.kept_text == want[r.doc_id, r.text]
        n = 0 if r.text is None else r.text.count("\n") + 1
        assert r.n_lines == n
    assert lines.drop_repeated_lines(empty).count() == 0


def test_lines_of_real_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain.without_repeated_lines(odd_rows(docs))
    got = lines.drop_repeated_lines(docs).collect()
    assert {(r.doc_id, r.kept_text) for r in got} == {(i, k) for (i, _), k in want.items()}


# --- links -----------------------------------------------------------------------------


@pytest.mark.parametrize(("longest", "cell"), [(16, 1000), (2, 3)])
def test_links(spark, odd, monkeypatch, longest, cell):
    monkeypatch.setattr(jaccard, "LIST", longest)
    monkeypatch.setattr(jaccard, "CELL", cell)
    rows = odd_rows(odd)
    want = plain.linked(rows)
    got = jaccard.link_documents(odd).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, want.get(i)) for i, _ in rows}
    assert sorted(r.n_shingles for r in got) == sorted(len(plain.shingles(t, 4)) for _, t in rows)
    assert sorted((r.doc_id, r.n_links) for r in got if r.doc_id is not None) == plain.link_counts(rows)
    assert all(r.n_links is None for r in got if r.doc_id is None)


def near_copies(n):
    """Copies of one text with one to three words changed each, and of another one."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        own = [f"w{k}" for k in range(60)] if i % 3 else [f"v{k}" for k in range(80)]
        for at in rng.integers(0, len(own), 1 + i % 4):
            own[at] = f"changed{i}-{at}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize(("longest", "cell"), [(16, 1000), (3, 10)])
def test_links_of_near_copies(spark, monkeypatch, longest, cell):
    monkeypatch.setattr(jaccard, "LIST", longest)
    monkeypatch.setattr(jaccard, "CELL", cell)
    rows = near_copies(60)
    # copies of near copies: a set may stand for several rows
    rows += [(100 + i, text.upper()) for i, text in rows[:9]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n, percent in ((4, 85), (5, 80), (3, 70)):
        want = plain.linked(rows, n, percent)
        got = jaccard.link_documents(docs, n, percent).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert sorted((r.doc_id, r.n_links) for r in got) == plain.link_counts(rows, n, percent)


def test_links_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST", 2)
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", 200)
    rows = near_copies(40)
    got = jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_links) for r in got) == plain.link_counts(rows)


def test_long_lists_tie_only_what_they_may_link(spark):
    """Of these sets a link needs 6 common first shingles, and only the last 20 sets share as many."""
    rows = []
    for i in range(60):
        own = [1000 * (i + 1) + k for k in range(20)]
        own[:1] = [1]  # a shingle of all
        if i >= 40:
            own[:8] = range(1, 9)
        rows.append((i, 100, np.array(own, np.uint64).tobytes()))
    heads = spark.createDataFrame(rows, "id long, size long, head binary")
    found = jaccard._families(heads, 85).collect()
    assert {r.node for r in found} == set(range(40, 60))
    assert len({r.component for r in found}) == 1


def test_short_and_long_lists_count_together(spark):
    """Two sets that meet in 4 short lists and 2 long ones, where 6 are needed."""
    both = [1, 2, 3, 4, 100, 101]
    rows = [(i, 100, [*both, *range(1000 * (i + 1), 1000 * (i + 1) + 14)]) for i in (0, 1)]
    rows += [(i, 100, [100, 101, *range(1000 * (i + 1), 1000 * (i + 1) + 18)]) for i in range(2, 40)]
    rows = [(i, size, np.array(own, np.uint64).tobytes()) for i, size, own in rows]
    heads = spark.createDataFrame(rows, "id long, size long, head binary")
    assert {tuple(r) for r in jaccard._families(heads, 85).collect()} == {(0, 0), (1, 0)}


def test_copies_of_a_block_are_made_one_at_a_time():
    block = pa.RecordBatch.from_pylist([{"component": 7, "own": 1, "blocks": 4, "blob": b"sets"}])
    block = block.cast(pa.schema([("component", pa.int64()), ("own", pa.int32()), ("blocks", pa.int32()), ("blob", pa.binary())]))
    copies = list(jaccard._sent(iter([block])))
    assert [c.num_rows for c in copies] == [1, 1, 1]
    cells = [tuple(c.to_pylist()[0].values()) for c in copies]
    assert cells == [(7, 0, 1, 1, b"sets"), (7, 1, 2, 1, b"sets"), (7, 1, 3, 1, b"sets")]


def test_intermediates_of_links_have_few_files(spark, monkeypatch):
    from goldkeep import shared

    monkeypatch.setattr(shared, "FILES_PER_CORE", 0)
    monkeypatch.setattr(shared, "PARTITIONS_PER_FILE", 4)
    rows = spark.range(0, 100, 1, 50)
    assert shared.settle(rows).rdd.getNumPartitions() == 50
    assert shared.settle(rows, few=True).rdd.getNumPartitions() == 2
    assert shared.settle(rows, few=True).count() == 100


def test_keep_one_shuffles_no_text(spark, join_path):
    rows = near_copies(30)
    want = plain.linked(rows)
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (join_path == "broadcast")
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if want[i] == i}


def test_links_empty(empty, odd):
    assert jaccard.link_documents(empty).count() == 0
    assert jaccard.keep_one(odd).columns == odd.columns


def test_components(spark, monkeypatch):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))]
    edges += [(k, k + 1) for k in range(400, 460)] + [(5, 5), (500, 600), (500, 600)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    want = {k: v for k, v in root.items() if any(k in e and e[0] != e[1] for e in edges)}
    df = spark.createDataFrame(edges, "a long, b long")
    for limit in (components.BROADCAST_BYTES, -1):
        monkeypatch.setattr(components, "BROADCAST_BYTES", limit)
        assert {r.node: r.component for r in components.components(df).collect()} == want
    assert components.components(df.limit(0)).count() == 0


# --- packing ---------------------------------------------------------------------------

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


MARKED = [
    "a<|endoftext|>b.", "<|startoftext|>", "x <|ENDOFTEXT|>, y", "<|EndOfText|>Z.", "A<|startoftext|><|endoftext|>B,", "it's <|endoftext|>. ok",
    "<|endoftext", "É<|endoftext|>é\u00a0x", "", None,
]


def ids_of(tokenizer, texts):
    ids, counts = tokenizer(pa.array(texts, pa.string()))
    return [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]


def test_ids_are_those_of_the_plain_call():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(TOKENIZER)
    for literal in (False, True):
        own.encode_special_tokens = literal
        want = [[*own.encode(t or "", add_special_tokens=False).ids, 2] for t in MARKED]
        assert ids_of(packing.WordTokenizer(TOKENIZER, 2, literal_marks=literal), MARKED) == want
    assert packing.splits_words(TOKENIZER)


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["two  Words\n.", "a<|endoftext|>b", None, ""]
    want = [[*Tokenizer.from_file(file).encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert not packing.splits_words(file) and ids_of(packing.WordTokenizer(file, 2), texts) == want


def test_packing_is_one_layout(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('some words ', cast(id % 37 as int)) as text").repartition(40)
    pieces = packing.pack_words(docs, TOKENIZER, 2, 256, open_windows=4)
    first = sorted(pieces.select("doc_id", "start", "length", "sequence_id", "offset").collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert sorted(pieces.select("doc_id", "start", "length", "sequence_id", "offset").collect()) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len({r.sequence_id for r in first if r.sequence_id >= 1 << 62}) > 3


@pytest.mark.parametrize(("window", "open_windows"), [(4096, 64), (64, 3)])
def test_packing(spark, odd, window, open_windows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    more = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = odd.select("doc_id", "text").unionByName(more.withColumn("doc_id", F.col("doc_id") + 1000))
    pieces = packing.pack_words(docs, TOKENIZER, 2, window, open_windows=open_windows)
    rows = pieces.collect()
    want = sorted(
        tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,) for _, t in odd_rows(docs)
    )
    # every id lies in one piece: put the pieces of documents together again
    names = {}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start)):
        assert len(r.ids) == 4 * r.length
        names.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert sum(r.length for r in rows) == sum(map(len, want))
    whole = {tuple(w) for w in want}
    for (_, tokens), own in names.items():
        if sum(r.length for r in own) == tokens:
            ids = b"".join(r.ids for r in own)
            assert tuple(np.frombuffer(ids, "<u4").tolist()) in whole
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in spans.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= window
    told = packing.padding(pieces, window).first()
    assert told.sequences == len(spans) and told.padding < 0.2 * told.tokens


def test_packing_empty(empty):
    assert packing.pack_words(empty, TOKENIZER, 2).count() == 0


def test_tokenizer_forgets(monkeypatch):
    texts = pa.array(["Ab, ab. AB don't", "<|endoftext|>x, é.", None, "a.b c,"])
    plain_ids = packing.WordTokenizer(TOKENIZER, 2)(texts)[0].tolist()
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 3)
    small = packing.WordTokenizer(TOKENIZER, 2)
    assert small(texts)[0].tolist() == small(texts)[0].tolist() == plain_ids


def test_substrings_heavy_minimiser(spark, monkeypatch):
    """One phrase is the minimiser of most windows, in ever other surroundings."""
    tried = [f"p{i} q{i} r{i}" for i in range(60_000)]
    spelled = words.split(pa.array(tried), words.WHITE_SPACE)
    phrase = tried[int(np.argmin(words.gram_hashes(words.word_hashes(spelled), 3)[::3]))]
    rng = np.random.default_rng(1)
    texts = [
        " ".join(f"w{rng.integers(10**6)} w{rng.integers(10**6)} {phrase}" for _ in range(120))
        for _ in range(200)
    ]
    texts += [t + " own end" for t in texts[:50]] + [f"own start {t}" for t in texts[25:60]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 100_000)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 100_000)
    heavy = substrings.heavy_minimisers(docs.select("text"), 13, 3, 40)
    assert len(heavy) >= 1
    spelled = words.split(pa.array(texts), words.WHITE_SPACE)

    def sizes(heavy):
        found = substrings._SuperKmers(spelled, 13, 3, heavy)
        length = [len(t) for t in found.distinct.to_pylist()]
        return np.bincount((words.mix(found.key) % np.uint64(40)).astype(int), length, minlength=40)

    assert sizes(heavy).max() < 2 * np.median(sizes(heavy))
    assert sizes(heavy[:0]).max() > 10 * np.median(sizes(heavy[:0]))
    want = plain.without_repeats(list(enumerate(texts)))
    got = substrings.drop_repeated_substrings(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.kept_text, r.n_removed) == want[r.doc_id, r.text]


# --- language model --------------------------------------------------------------------


@pytest.mark.parametrize("size, order", [(24 << 20, 3), (20_000, 3), (20_000, 2), (60_000, 4)])
def test_katz(spark, odd, monkeypatch, size, order):
    monkeypatch.setattr(katz, "BUCKET_BYTES", size)
    more = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = odd.select("doc_id", "text").unionByName(more)
    learnt = F.col("doc_id") % 5 != 0
    got = katz.score_texts(docs, learnt, order=order).collect()
    rows = odd_rows(docs)
    assert len(got) == len(rows)
    train = [t for i, t in rows if i is not None and i % 5]
    model = plain.Katz(train, katz.good_turing, katz.DISCOUNTED + 1, order)
    size = len(model.one) + 1
    want = []
    for i, t in rows:
        tokens = model.tokens(t)[order - 1 :]
        base = sum(np.log10((model.one[w] + 1) / (model.total + size)) for w in tokens)
        known = sum(model.one[w] > 0 for w in tokens)
        want.append((str(i), len(tokens), known, model.total, base, model.score(t)))
    found = [
        (str(r.id), r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got
    ]
    for a, b in zip(sorted(found), sorted(want)):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_katz_names(spark, odd, monkeypatch):
    """Names of six to eight bits, most words listed, a task that holds ten words: the scores are
    those of long names."""
    monkeypatch.setattr(katz, "BUCKET_BYTES", 20_000)
    more = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = odd.select("doc_id", "text").unionByName(more)
    learnt = F.col("doc_id") % 5 != 0

    def scores():
        return sorted((str(r.id), *r[1:]) for r in katz.score_texts(docs, learnt).collect())

    want = scores()
    monkeypatch.setattr(katz, "LEAST_BITS", 6)
    monkeypatch.setattr(katz, "MOST_BITS", 8)
    monkeypatch.setattr(katz, "MOST_FREQUENT", 50)
    monkeypatch.setattr(katz, "MOST_ALIKE", 20)
    monkeypatch.setattr(katz, "HELD_WORDS", 10)
    got = scores()
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


def test_katz_sends_little(spark, monkeypatch):
    """A word costs a bucket less than half of a 64-bit hash, and buckets of a family send the sums
    of a part at once."""
    monkeypatch.setattr(katz, "BUCKET_BYTES", 40_000)
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 20_000, 300)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    grams, counted, naming = katz.ngram_tables(docs, F.lit(True))
    rows = grams.where("kind = 'questions'").select("blob").collect()
    asked = [blobs.unpack_arrays(r.blob)["words"] for r in rows]
    sent = [len(blobs.pack_arrays(w=w)) - len(blobs.pack_arrays(w=w[:0])) for w in asked]
    assert sum(sent) < 4 * sum(map(len, asked))
    assert not len(naming.value.heads)
    numbers = np.zeros(katz.DISCOUNTED + 2, int)
    model = SimpleNamespace(value=katz.Model.of({k: numbers for k in (1, 2, 3)}, 20_000, 400 * 301))
    spread = SimpleNamespace(value=(np.zeros(0, np.uint64), np.zeros((3, 0))))
    family = grams.where("family = 0 and kind in ('grams', 'occurrences')").toArrow()
    answers = counted.where("kind = 'answers'").select("bucket", "target", "blob").toArrow()
    sums = katz._evaluate(3, model, spread)(family, answers)
    assert len(set(family["bucket"].to_pylist())) == 1 << katz.FAMILY
    assert sorted(sums["target"].to_pylist()) == sorted(set(family["target"].to_pylist()))
    known = [blobs.unpack_arrays(b)["known"].sum() for b in sums["blob"].to_pylist()]
    occurred = family.filter(pc.equal(family["kind"], "occurrences"))["docs"].to_pylist()
    assert sum(known) == sum(len(blobs.unpack_arrays(d)["docs"]) for d in occurred)


def test_good_turing():
    """Discounts written out for counts of counts 100, 40, 20, 10, 5 and 3."""
    top = 6 * 3 / 100
    want = [(ratio - top) / (1 - top) for ratio in (0.8, 0.75, 2 / 3, 0.625, 0.72)]
    assert katz.good_turing(np.array([0, 100, 40, 20, 10, 5, 3])) == pytest.approx([0, *want, 1])
    # no counts of counts to go by
    assert katz.good_turing(np.zeros(7, int))[1:3] == pytest.approx([0.5, 0.75])


def test_katz_sums_to_one(spark, monkeypatch):
    """Every word after every context, the operator's own scores: one text per ending, less the
    score of the text without it."""
    monkeypatch.setattr(katz, "BUCKET_BYTES", 40)
    texts = ["a b c a b", "b c c d", "a a a", "e"] * 3
    words = ["a", "b", "c", "d", "e", "never"]
    # a score of "x y w" begins with those of x and y, which all endings share
    contexts = ["a b", "b c", "c d", "never a", "never never"]
    rows = [(i, t, True) for i, t in enumerate(texts)]
    tried = [(c, w) for c in contexts for w in words]
    rows += [(1000 + i, f"{c} {w}", False) for i, (c, w) in enumerate(tried)]
    rows += [(5000 + i, c, False) for i, c in enumerate(contexts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    got = {r.id: r.score for r in katz.score_texts(docs, F.col("learn")).collect()}
    model = plain.Katz(texts, katz.good_turing, katz.DISCOUNTED + 1)
    for i, c in enumerate(contexts):
        x, y = c.split()
        begun = model.probability(("<begin>",) * 2, x) * model.probability(("<begin>", x), y)
        # the end follows as the token of the context alone
        total = 10 ** got[5000 + i] / begun
        for j, (d, w) in enumerate(tried):
            if d == c:
                total += 10 ** got[1000 + j] / begun / model.probability((y, w), "<end> ")
        assert total == pytest.approx(1)


def test_katz_without_training(odd, empty):
    rows = katz.score_texts(odd, F.lit(False)).collect()
    assert len(rows) == odd.count()
    assert all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in rows)
    assert katz.score_texts(empty, F.lit(True)).count() == 0


# --- sharding --------------------------------------------------------------------------


def test_sharding(odd, empty):
    got = sharding.shard_by_bytes(odd, 4).collect()
    rows = odd_rows(odd)
    sized = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    order = sorted(sized, key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[1]))
    total, before, want, slots = sum(r[1] for r in sized), 0, [], {}
    for i, size, crc in order:
        shard = (2 * before + size) * 4 // (2 * total)
        slots[shard] = slots.get(shard, -1) + 1
        want.append((i, size, crc, shard, slots[shard]))
        before += size
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sharding.shard_by_bytes(empty, 4).count() == 0


# --- neighbours ------------------------------------------------------------------------


def brute(rows, k):
    good = [
        (i, np.array(v, float)) for i, v in rows
        if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    out = set()
    for q, v in good:
        if q % 5 == 0:
            ranked = sorted(((-(x * v).sum(), i) for i, x in good if i != q))[:k]
            out |= {(q, n + 1, i) for n, (_, i) in enumerate(ranked)}
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # many equal vectors
    rows += [(2000, None), (2005, [0.0] * 8), (2010, [1.0, None] + [0.0] * 6), (2015, [float("nan")] * 8),
             (2020, [float("inf")] * 8), (2025, [1.0]), (None, [1.0] * 8), (2030, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int".rsplit(",", 1)[0])
    got = {(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(df, F.col("id") % 5 == 0, 20).collect()}
    want = brute(rows, 20)
    assert len(got) == len(want)
    assert len(got & want) >= 0.9 * len(want)
    few = spark.createDataFrame(rows[:7], "vec_id long, embedding array<float>")
    got = {(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(few, F.col("id") % 5 == 0, 20).collect()}
    assert got == brute(rows[:7], 20)
    assert neighbours.nearest(few.limit(0), F.col("id") % 5 == 0).count() == 0
    assert neighbours.nearest(few, F.lit(False)).count() == 0


def test_neighbours_of_repeated_ids(spark):
    rng = np.random.default_rng(4)
    same = [3.0, -2.0, 1.0, 3.0, 2.0, -3.0, 1.0, 2.0]
    rows = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(100, 140)]
    # one id in more rows than are asked for, and larger ids with the same vector
    rows += [(0, same)] * 30 + [(7, same), (8, same)] + [(10, same)] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.nearest(df, F.col("id").isin(0, 10), 20)
    got = {(r.query_id, r["rank"], r.vec_id) for r in found.collect()}
    assert {i for q, _, i in got if q == 0} >= {7, 8, 10}
    assert {(q, n, i) for q, n, i in brute(rows, 20) if q in (0, 10) and n <= 5} <= got
    assert len(got) == 40


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((500, 16))
    codes = neighbours.learn(vectors, float(np.linalg.norm(vectors, axis=1).max()), bits=64)
    index = neighbours.Index(codes, np.arange(500), vectors)
    bits = codes.bits(vectors, query=False)
    asked = codes.bits(vectors[:5], query=True)
    for row, parts in zip(asked, codes.parts(asked)):
        for radius in (0, 3, 9, 20, 40):
            near = np.flatnonzero((bits != row).sum(1) <= radius)
            assert index.within(parts, radius).tolist() == near.tolist()


def test_recall_on_real_rows(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in df.collect()]
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(df, F.col("id") % 20 == 0).collect()}
    want = set()
    for q, v in rows:
        if q % 20 == 0:
            want |= {(q, i) for _, i in sorted((-(x * v).sum(), i) for i, x in rows if i != q)[:20]}
    assert len(got & want) >= 0.9 * len(want)


# --- substrings ------------------------------------------------------------------------


@pytest.mark.parametrize("size", [4 << 20, 5_000])
def test_substrings(odd, empty, monkeypatch, size):
    monkeypatch.setattr(substrings, "CHUNK_BYTES", size)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", size)
    rows = odd_rows(odd)
    for window in (13, 2):
        want = plain.without_repeats(rows, window)
        got = substrings.drop_repeated_substrings(odd, window)
        assert got.columns.count("n_words") == 1
        got = got.collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.kept_text, r.n_removed) == want[r.doc_id, r.text]
            assert r.n_words == len(plain.spaced(r.text))
    assert substrings.drop_repeated_substrings(empty).count() == 0


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "gram_hashes", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    found = words.split(pa.array(["a b c a b d a b c"]), words.WHITE_SPACE)
    _, group = substrings._window_groups(found, 3)
    assert group[0] == group[6] and len(set(group.tolist())) == 6


