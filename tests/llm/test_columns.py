"""Tables whose columns are named like everything an operator uses inside."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from goldkeep.llm import (
    alignment,
    chat,
    components,
    decontaminate,
    divergence,
    jaccard,
    katz,
    lines,
    neighbours,
    packing,
    sharding,
    substrings,
    toxicity,
    urls,
)
from goldkeep.operators import joins

BPE, PIECES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
TEXTS = ["one two three four five\nsix\nseven\neight", "one two three four five\nsix\nseven\neight", "you vile scum " * 3, None, ""]


def with_clashes(frame, *modules):
    """``frame`` with a text column for every name that the modules spell."""
    found = set()
    for module in (*modules, joins, components):
        found |= set(re.findall(r'"(_?[a-z][a-z0-9_]*)"', Path(module.__file__).read_text()))
    taken = {c.lower() for c in frame.columns}
    return frame.select("*", *[F.lit(f"own {n}").alias(n) for n in sorted(found - taken)])


def kept(got, frame, added):
    """Every own column comes back with its value, unless a result has that name."""
    names = [c for c in frame.columns if c not in added]
    assert set(names) <= set(got.columns) and len(set(got.columns)) == len(got.columns)
    own = [n for n in names if frame.schema[n].dataType.simpleString() == "string" and n != "text"]
    rows = got.select(*own).collect()
    assert rows and all(r[n] in (f"own {n}", "en", "s") for r in rows for n in own)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_decontaminate(spark, docs):
    frame = with_clashes(docs, decontaminate)
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = decontaminate.decontaminate(frame, items)
    kept(got, frame, set(got.columns) - set(docs.columns) - {n for n in frame.columns} | {"n_words", "hit_words", "found_items"})


def test_toxicity(spark, docs):
    frame = with_clashes(docs, toxicity)
    labels = with_clashes(spark.createDataFrame([(0, 0), (1, 0), (2, 1)], "doc_id long, toxic int"), toxicity)
    kept(toxicity.score_toxicity(frame, toxicity.train(frame, labels)), frame, {"toxicity"})


def test_lines(docs):
    frame = with_clashes(docs, lines)
    kept(lines.drop_repeated_lines(frame), frame, lines.ADDED)


def test_substrings(docs):
    frame = with_clashes(docs, substrings).withColumn("c0", F.lit("own c0"))
    kept(substrings.drop_repeated_substrings(frame), frame, substrings.ADDED)


def test_near_duplicates(docs):
    frame = with_clashes(docs, jaccard)
    kept(jaccard.keep_one(frame), frame, ())
    assert jaccard.link_documents(frame).count() == len(TEXTS)


def test_urls(spark):
    pages = with_clashes(spark.createDataFrame([(1, "http://a.net/", "<link rel=canonical href=/b>")], "page_id long, url string, html string"), urls)
    rules = with_clashes(spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string"), urls)
    links = urls.page_links(pages)
    frame = pages.drop("html")
    got = urls.judge(frame, rules.select("host", "path", "verdict"), links)
    kept(got, frame.drop("url"), urls.ADDED)
    assert got.first().verdict == "block"


def test_operators_that_read_some_columns(spark, docs):
    """Columns they do not read make no difference to them."""
    said = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ok")], "conv_id long, turn long, role string, text string")
    vectors = spark.createDataFrame([(i, [1.0 * i, 1.0, 0.5]) for i in range(30)], "vec_id long, vec array<double>")
    langs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    runs = [
        (said, chat, lambda f: chat.format_conversations(f)),
        (docs, packing, lambda f: packing.pack_words(f, WORDS, 2)),
        (docs, katz, lambda f: katz.score_texts(f, F.lit(True))),
        (docs, sharding, lambda f: sharding.shard_by_bytes(f, 2)),
        (docs, alignment, lambda f: alignment.align_texts(f, BPE, PIECES)),
        (langs, divergence, lambda f: divergence.audit(f, 1)),
    ]
    for frame, module, run in runs:
        plain, wide = run(frame), run(with_clashes(frame, module))
        common = [c for c in plain.columns if c in wide.columns]
        assert common and plain.count() == wide.count(), module.__name__
    assert vectors.count() == 30 and neighbours.__doc__
