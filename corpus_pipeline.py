"""From raw documents to packed token sequences.

Each stage takes what the one before it has written and acts on all of it:

1. ``toxicity`` drops documents whose score is at least ``TOXIC``;
2. ``line_dedup`` takes repeated runs of lines out of the texts (and updates ``n_chars``);
3. ``near_duplicates`` keeps the smallest id of each group of linked documents;
4. ``decontamination`` drops documents in which a window of a benchmark item occurs;
5. ``packing`` cuts and packs the tokens of what is left.

All but the last return the columns of ``documents``. The first needs a fitted model and the
last a tokenizer, so the whole has no SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from goldkeep.llm import decontaminate, jaccard, lines, packing, toxicity
from goldkeep.shared import scratch_path

#: Documents with this score or more are dropped.
TOXIC = 0.7
#: Words of a shingle for near duplicates, and the percentage from which two are linked.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model fitted on the labelled ones finds harmless."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    return scored.where(F.col("toxicity") < TOXIC).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in an earlier one; none is dropped."""
    kept = lines.drop_repeated_lines(docs)
    text = F.col("kept_text")
    length = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length.cast("long")).withColumn("text", text).select(*COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return jaccard.keep_one(docs, shingle=NEAR_SHINGLE, percent=NEAR_PERCENT).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, items)
    return found.where(F.size("hit_words") == 0).select(*COLUMNS)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with the sequence and offset of each."""
    return packing.pack_words(docs, public_tokenizers.path("word_bpe_49k.json"), end=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_tokens),
]

#: A fitted model and a tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
