"""Alignment of tokenizers, address rules and source divergence against plain versions."""

import json
import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from test_operators import LONG, empty, odd  # noqa: F401
from tokenizers import Tokenizer

import public_tokenizers
from goldkeep.llm import alignment, divergence, transducer, urls
from goldkeep.llm.queries import URL_RULES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

# --- alignment -------------------------------------------------------------------------

SPELLINGS = [
    "plain words, it's 3.14 of them", "two  spaces \n\n and lines \t", " leads", "trails ", "  ", " ", "\n",
    "<|endoftext|> and <s> or </s> <0x41>", "U+2581 \u2581here", "a\u00a0 b\u3000 c\u2003 d\u0085 e", "été où naïve Ärger",
    "日本語 テキスト です", "x\x00y \x01 z", "👩‍👩‍👧 ok", "don't we'll I'M", "a" * 3000, "é" + " é" * 400, "𝔘 𝔫 𝔦",
]


@pytest.fixture(scope="module")
def plain_tokens():
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()

    def spell_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()

    return (
        lambda t: a.encode(t, add_special_tokens=False).ids,
        lambda t: b.encode(t),
        lambda i: bytes(letters[c] for c in a.id_to_token(i)),
        spell_b,
    )


def test_align_texts(spark, odd, plain_tokens, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_ROWS", 3)
    docs = [(100 + i, t) for i, t in enumerate(SPELLINGS)] + [(r.doc_id, r.text) for r in odd.collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    frame = frame.withColumns({c: F.lit("kept out") for c in ("chunk", "ids", "pair", "at", "groups", "count", "n_a")})
    got = alignment.align_texts(frame, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    want = plain.aligned(docs, *plain_tokens)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sum(w[1] == 0 for w in want) >= 3  # null, empty, U+2581


def test_align_nothing(spark, empty):
    assert alignment.align_texts(empty, A, B).count() == 0


UNITS = st.lists(st.sampled_from([" ", "  ", "\n", "a", "été", "it's", "12", ".", "\u00a0", "\u3000", "日", "\t", "<s>", "\x00"]), max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(UNITS, max_size=4))
def test_units_equal_whole_texts(plain_tokens, parts):
    texts = ["".join(p) for p in parts]
    own = alignment.aligner(A, B)
    _, found, groups = own.chunk(pa.array(texts, pa.string()))
    said, held, at = groups.to_pylist(), found["held"], 0
    for text, n in zip(texts, held["counts"].tolist()):
        units = [said[u] for u in held["code"][at : at + n].tolist()]
        at += n
        assert ";".join(units) == plain.aligned([(0, text)], *plain_tokens)[0][-1]


def test_whole_texts_where_files_do_not_warrant_cuts(tmp_path, plain_tokens):
    own = json.loads(open(A, encoding="utf-8").read())
    own["pre_tokenizer"]["use_regex"] = False
    file = tmp_path / "joined.json"
    file.write_text(json.dumps(own), encoding="utf-8")
    joined = alignment.Aligner(str(file), B)
    assert not joined.cuts and alignment.aligner(A, B).cuts
    assert joined.units(pa.array(["a b c", None, "", "d e"])).counts.tolist() == [1, 0, 0, 1]


def test_lockstep_forgets_nothing(plain_tokens, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED_UNITS", 5)
    own = alignment.Aligner(A, B)
    for text in ["one two three four five six", "seven one eight nine ten eleven two", "one two"]:
        _, found, groups = own.chunk(pa.array([text]))
        said = groups.to_pylist()
        assert ";".join(said[u] for u in found["held"]["code"]) == plain.aligned([(0, text)], *plain_tokens)[0][-1]


# --- addresses -------------------------------------------------------------------------

ADDRESSES = [
    "http://a.net/", "http://a.net", "http://net/x", "http://xnet/", "https://WWW.Example.NET/en/1#top", "https://example.net/en",
    "http://x.example.com/de/", "http://example.com/DE/", "http://b.org/fr/1?x=http://c.net/", "http://plain.org/1", "http://plain.org/2",
    "http://plain.org/3#a", "http://user@h.net:80/", "no scheme", "", None, "://", "x://?q", "http://a..net/", "http://n\u00e9.org/fr/",
    "http://shown.org/", "http://alias.org/", "http://other.org/",
]
LINKS = [
    ("http://plain.org/1", "http://PLAIN.org/2#z"), ("http://plain.org/2", "http://a.net/bad"), ("http://plain.org/3", "http://plain.org/3#b"),
    ("https://www.example.net/en/1", "http://a.net/bad"), ("http://shown.org/", "http://example.net/en/9"), (None, "http://plain.org/1"),
    ("no scheme", "http://a.net/"), ("http://other.org/", "http://plain.org/1"),
]


def judged(spark, pages, rules, links):
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumns({c: F.lit("own") for c in ("row", "u", "v", "node", "at", "blocked", "component", "host")})
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    edges = None if links is None else spark.createDataFrame(links, "source string, target string")
    return urls.judge(frame, table, edges)


@pytest.mark.parametrize("links", [LINKS, []])
def test_judge(spark, links, join_path):
    pages = list(enumerate(ADDRESSES)) + [(3, ADDRESSES[0]), (None, ADDRESSES[9])]
    got = judged(spark, pages, URL_RULES, links).collect()
    known = [pair for pair in links if all(u and "://" in u for u in pair)]
    want = plain.verdicts([u for _, u in pages], URL_RULES, known)
    expected = []
    for (page, url), verdict in zip(pages, want):
        host, path, rule = plain.rule_of(url, URL_RULES)
        expected.append((page, url, host, path, rule and rule[0] + rule[1], verdict))
    found = [(r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert all(r.u == r.v == r.node == r.at == r.blocked == r.component == "own" and r["row"] == "own" for r in got)
    if links:  # an alias of a blocked target is blocked, an explicitly allowed one is not
        of = {r.url: r.verdict for r in got}
        assert of["http://plain.org/1"] == of["http://other.org/"] == "block"
        assert of["https://WWW.Example.NET/en/1#top"] == "allow" == of["http://shown.org/"]


def test_judge_empty(spark):
    none = judged(spark, [], URL_RULES, LINKS)
    assert none.count() == 0 and {"host", "path", "rule", "verdict"} <= set(none.columns)
    free = judged(spark, list(enumerate(ADDRESSES)), [], LINKS).collect()
    assert len(free) == len(ADDRESSES) and all(r.rule is None and r.verdict == "allow" for r in free)
    assert judged(spark, [(1, "http://a.net/")], URL_RULES + [(None, "/", "allow"), ("net", "/", "allow")], None).first().verdict == "allow"


def test_page_links(spark):
    pages = [
        ("http://a.org/x/y", '<html><head><link rel="Canonical alternate" href="/z"><meta http-equiv=refresh content="0; URL=\'q?1\'"></head>'),
        ("http://b.org/", '<!-- <link rel=canonical href="/no"> --><script>"<link rel=canonical href=/no>"</script><link href=http://c.org rel=canonical>'),
        ("http://c.org/d/", '<base href="http://e.org/f/"><link rel=canonical href="g"><link rel=canonical><link rel=canonical href="http://[bad">'),
        ("http://d.org/", None), ("none", "<link rel=canonical href=http://a.org>"), (None, "canonical"), ("http://f.org/", "<link rel=icon href=canonical"),
    ]
    found = urls.page_links(spark.createDataFrame(pages, "url string, html string")).collect()
    assert sorted(map(tuple, found)) == [
        ("http://a.org/x/y", "http://a.org/x/q?1"), ("http://a.org/x/y", "http://a.org/z"),
        ("http://b.org/", "http://c.org"), ("http://c.org/d/", "http://e.org/f/g"),
    ]


# --- divergence ------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6) | st.text("ab", min_size=1, max_size=8).map(str.encode), max_size=60))
def test_transducer_gives_ordinals(terms):
    ordered = sorted(terms)
    machine = transducer.Transducers(
        ("v", part[0], start, transducer.packed(part))
        for start in range(0, len(ordered), 7)
        for part in [ordered[start : start + 7]]
    )
    asked = ordered + [t + b"x" for t in ordered] + [t[:-1] for t in ordered] + [b"", b"\xff" * 9]
    data = b"".join(asked)
    ends = np.cumsum([len(t) for t in asked])
    starts = ends - [len(t) for t in asked]
    got = machine.ordinals_of(np.frombuffer(data or b" ", np.uint8), starts, ends, machine.shard_of("v", asked))
    place = {t: i for i, t in enumerate(ordered)}
    assert got.tolist() == [place.get(t, -1) for t in asked]
    assert (machine.shard_of("other", asked) == -1).all()


def test_transducer_is_minimal():
    terms = sorted({(a + b + "s").encode() for a in ("walk", "talk", "balk") for b in ("", "ing", "er")})
    built = transducer.build(terms)
    # the classes of equal endings are counted from the terms themselves
    endings = {frozenset(t[i:] for t in terms if t[:i] == p) for p in {t[:i] for t in terms for i in range(len(t) + 1)} for i in [len(p)]}
    assert len(built["final"]) == len(endings)
    with pytest.raises(ValueError):
        transducer.build([b"b", b"a"])


def corpus():
    rng = random.Random(7)
    words = ["Alpha", "beta", "gamma's", "delta9x", "ÉTÉ", "naïve", "日本", "the", "THE", "zz_top"]
    rows = [
        (rng.choice(["en", "de", None]), f"s{rng.choice([0, 0, 0, 1, 2, 3])}", " ".join(rng.choices(words, k=rng.randint(0, 12))))
        for _ in range(120)
    ]
    return rows + [("fr", "s1", "once"), ("fr", "s2", None), ("fr", "s2", ""), ("es", None, "alone"), ("en", "s0", LONG)]


@pytest.mark.parametrize("small", [False, True])
def test_audit(spark, monkeypatch, small):
    if small:  # several transducers, blocks, hand-overs and tiles
        for name, value in (("SHARD_TERMS", 2), ("BLOCK_BYTES", 9000), ("COUNTED", 10), ("TILE_SOURCES", 2), ("TILE_TERMS", 3)):
            monkeypatch.setattr(divergence, name, value)
    docs = corpus()
    frame = spark.createDataFrame(docs, "lang string, source string, text string").repartition(5)
    frame = frame.withColumns({c: F.lit("x") for c in ("term", "ordinal", "n", "share", "value", "rank", "at", "doc_id")})
    got = divergence.audit(frame, least=9, top=4)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(plain.divergence(docs, 9, 4))


def test_rows_of_a_tile_may_come_in_any_order(spark, monkeypatch):
    tile = divergence._tile

    def shuffled(group: pa.Table) -> pa.Table:
        mixed = np.random.default_rng(group["low"][0].as_py()).permutation(group.num_rows)
        return tile(group.take(pa.array(mixed)))

    monkeypatch.setattr(divergence, "TILE_TERMS", 3)
    monkeypatch.setattr(divergence, "_tile", shuffled)
    docs = corpus()
    got = divergence.audit(spark.createDataFrame(docs, "lang string, source string, text string"), least=2, top=4)
    assert sorted(map(tuple, got.collect())) == sorted(plain.divergence(docs, 2, 4))


def test_audit_of_odd_tables(spark):
    schema = "lang string, source string, text string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    docs = [(None, None, None), ("x", "a", ""), ("x", "b", "few")]
    got = divergence.audit(spark.createDataFrame(docs, schema)).collect()
    assert sorted(map(tuple, got)) == [("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)]
    copies = [("x", s, t) for s, t in (("a", "same words here"), ("b", "same words here")) for _ in range(40)]
    got = divergence.audit(spark.createDataFrame(copies, schema)).collect()
    assert sorted(map(tuple, got)) == sorted(plain.divergence(copies, 30, 50))
