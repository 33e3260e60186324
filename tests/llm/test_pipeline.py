"""The pipeline on a small corpus, every stage against its plain version."""

import plain
import pytest
from pyspark.sql import types as T

import corpus_pipeline
from goldkeep.llm import toxicity

PASSAGE = "the quick brown fox jumps over a lazy dog while seven owls watch from the old barn"
BOILER = "first shared line\nsecond shared line\nthird shared line"


def corpus():
    rng = list(range(400))
    texts = [" ".join(f"w{(i * 37 + k * k) % 977}" for k in rng[: 60 + i]) for i in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100, texts[3]), (101, texts[3] + " tail"), (102, texts[5].replace("w5 ", "w6 ", 1))]
    rows += [(200, f"some words before {PASSAGE} and some after"), (201, "nothing to see here at all")]
    rows += [(300, f"alpha\n{BOILER}\nbeta"), (301, f"gamma\n{BOILER}\ndelta"), (302, BOILER)]
    rows += [(400 + i, f"you are a worthless scumbag number {i} " * 3) for i in range(40)]
    rows += [(500, None), (501, ""), (None, "no id here"), (502, "word " * 9000)]
    return [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(corpus(), schema).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0, int(400 <= i < 430)) for i, *_ in corpus() if i is not None and i < 430]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, PASSAGE), (2, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = pairs(docs)
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name == "toxicity":
            labels = spark.read.parquet(f"{folder}/labels.parquet")
            model = toxicity.train(docs, labels)
            scored = toxicity.score_toxicity(docs, model).where("toxicity < 0.7")
            assert pairs(after) == pairs(scored)
            left = {i for i, _ in pairs(after)}
            assert not left & set(range(400, 440)) and set(range(30)) | {None, 500} <= left
        elif name == "line_dedup":
            kept = plain.without_repeated_lines(before)
            want = sorted(((i, kept[i, t]) for i, t in before), key=repr)
            assert pairs(after) == want and (302, "") in want
        elif name == "near_duplicates":
            root = plain.linked(before, 5, 80)
            assert pairs(after) == [(i, t) for i, t in before if i is None or root[i] == i]
        elif name == "decontamination":
            items = [(1, PASSAGE), (2, None)]
            assert pairs(after) == [(i, t) for i, t in before if not plain.hits(t, items)[0]]
        else:
            rows = after.collect()
            assert {r.doc_id for r in rows} == {i for i, _ in before}
            assert max(r.offset + r.length for r in rows) <= 4096
            break
        assert after.columns == list(corpus_pipeline.COLUMNS)
        docs = after


def test_run(spark, folder):
    done = corpus_pipeline.run(spark, folder)
    assert done.schema["ids"].dataType == T.BinaryType()
    assert {r.doc_id for r in done.select("doc_id").collect()} >= {None, 500, 501, 502}
