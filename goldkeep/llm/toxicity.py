"""Toxicity of whole texts: a linear model over character n-grams.

The value of an n-gram that a text contains is its naive Bayes log-count ratio, learnt from
labelled texts: how much likelier it is in a toxic text. Values are divided by the square root
of the number of distinct n-grams of the text, so length does not matter, and weighed by a
logistic regression. Only n-grams with a clear ratio carry a weight; all others count in the
length alone.

The model is fitted on a bounded sample of labelled rows: at most ``SAMPLE`` rows and
``SAMPLE_BYTES`` bytes of text of each class, in the order of a hash of their id. Rows equal in id
and text are learnt from once. Rows are weighed so that toxic ones make up ``PRIOR`` of the whole, whatever
their share of the labels or of the sample: a score means the same for few labels and for many.
Scoring reads every text once and shuffles nothing. No other column than the text enters a score.

Results for unusual input: a null or empty text scores as one without n-grams; labels that are
null are not learnt from; with labels of one class only, every score is that of the class
share; ids may repeat or be null (those are not learnt from); columns of the documents named
like a result column are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldkeep.llm.blobs import pack_arrays, unpack_arrays
from goldkeep.llm.words import slices
from goldkeep.shared import settle

#: Most labelled rows of each class that the model is fitted on.
SAMPLE = 2000
#: Most bytes of their texts, of each class.
SAMPLE_BYTES = 16 << 20
#: Share of toxic texts that scores are meant for.
PRIOR = 0.1
#: Lengths of the n-grams in characters, and how many hashed n-grams are told apart.
ORDERS = (5, 6)
FEATURES = 1 << 20
#: N-grams in fewer sample texts, or with a smaller ratio, carry no weight.
MIN_TEXTS, MIN_RATIO = 5, 1.0
ROUNDS, PENALTY = 1500, 1e-7


def text_grams(value: str | None) -> np.ndarray:
    """Distinct hashed n-grams of the characters of a text, A-Z in lower case, with a blank at
    both ends."""
    text = np.frombuffer(f" {value or ''} ".encode("utf-32-le"), np.uint32).copy()
    text[(text >= ord("A")) & (text <= ord("Z"))] += 32
    found = []
    for n in ORDERS:
        if len(text) >= n:
            h = np.full(len(text) - n + 1, n, np.uint32)
            for i in range(n):
                h *= np.uint32(0x01000193)
                h ^= text[i : len(h) + i]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            h ^= h >> np.uint32(12)
            found.append(h & np.uint32(FEATURES - 1))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)


@dataclass
class Model:
    """``weights`` of the hashed n-grams, ratio and regression in one, and the intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, texts: pa.Array) -> np.ndarray:
        margin = np.empty(len(texts))
        for i in range(len(texts)):  # one text at a time is held as characters
            grams = text_grams(texts[i].as_py())
            margin[i] = self.weights[grams].sum() / np.sqrt(max(1, len(grams)))
        return 1 / (1 + np.exp(-np.clip(margin + self.intercept, -500, 500)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        grams = [text_grams(batch.column(0)[i].as_py()) for i in range(batch.num_rows)]
        blob = pack_arrays(
            # ordered within a text, so their differences are small
            steps=np.diff(np.concatenate([np.zeros(1, np.uint32), *grams])),
            size=np.array([len(g) for g in grams], np.int32),
            label=batch.column(1).to_numpy(zero_copy_only=False).astype(np.int8),
        )
        yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])


def _texts(blobs: list[bytes]) -> Iterator[tuple[np.ndarray, int]]:
    """Distinct n-grams and label of each text."""
    for blob in blobs:
        part = unpack_arrays(blob)
        ends = np.cumsum(part["size"])
        grams = np.split(np.cumsum(part["steps"], dtype=np.uint32), ends[:-1])
        yield from zip(grams, part["label"].tolist())


def fit(blobs: list[bytes], prior: float = PRIOR) -> Model:
    """Log-count ratios and regression weights from packed n-grams of labelled texts, of which
    the toxic ones together weigh ``prior`` of all."""
    counts = np.zeros((2, FEATURES), np.int64)
    labels, lengths = [], []
    for grams, label in _texts(blobs):
        counts[label][grams] += 1  # the n-grams of a text are distinct
        labels.append(label)
        lengths.append(len(grams))
    y = np.array(labels, float)
    clean, toxic = counts
    ratio = np.log((toxic + 1) / (toxic.sum() + FEATURES)) - np.log(
        (clean + 1) / (clean.sum() + FEATURES)
    )
    ratio[(toxic + clean < MIN_TEXTS) | (np.abs(ratio) < MIN_RATIO)] = 0
    one_class = y.min(initial=1) == y.max(initial=0)
    share = prior if len(y) and not one_class else y.max(initial=0)
    share = float(np.clip(share, 1e-6, 1 - 1e-6))
    start = np.log(share / (1 - share))
    clear = [grams[ratio[grams] != 0] for grams, _ in _texts(blobs)]
    size = np.array([len(c) for c in clear], np.int64)
    if one_class or not size.any():
        return Model(np.zeros(FEATURES), start)
    texts = len(y)
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    of = np.repeat(np.arange(texts), size)
    used, column = np.unique(np.concatenate(clear), return_inverse=True)
    value = ratio[used][column] / np.sqrt(np.array(lengths))[of]

    def margins(w):
        return np.bincount(of, value * w[column], minlength=texts)

    def pull(residual):
        return np.bincount(column, value * residual[of], minlength=len(used)) / texts

    # largest curvature by power iteration, then accelerated gradient steps
    direction = np.ones(len(used))
    for _ in range(20):
        direction = pull(weight * margins(direction))
        curvature = np.linalg.norm(direction)
        direction /= curvature
    step = 1 / (0.3 * curvature + PENALTY)
    w = ahead = np.zeros(len(used))
    b = b_ahead = start
    for i in range(ROUNDS):
        residual = 1 / (1 + np.exp(-np.clip(margins(ahead) + b_ahead, -500, 500))) - y
        residual *= weight
        new = ahead - step * (pull(residual) + PENALTY * ahead)
        new_b = b_ahead - 2 * residual.mean()
        momentum = i / (i + 3)
        ahead, b_ahead = new + momentum * (new - w), new_b + momentum * (new_b - b)
        w, b = new, new_b
    weights = np.zeros(FEATURES)
    weights[used] = ratio[used] * w
    return Model(weights, b)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learnt: Column | None = None,
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    prior: float = PRIOR,
) -> Model:
    """A model from the texts whose ids ``labels`` names and ``learnt`` admits."""
    known = labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
    known = known.select(F.col(id_column).alias("_id"), F.col(label_column).alias("_label"))
    if learnt is not None:
        known = known.where(learnt)
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    chosen = [
        known.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        for c in (0, 1)
    ]
    # at most two times ``sample`` ids, but an id may have any number of rows
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = docs.select(
        F.col(id_column).alias("_id"),
        F.col(text_column).alias("_text"),
        F.xxhash64(text_column).alias("_digest"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).alias("_bytes"),
    )
    rows = texts.join(chosen, "_id")
    order = [F.xxhash64("_id"), F.col("_id"), F.col("_digest")]
    distinct = rows.select("_id", "_digest", "_label", "_bytes").distinct()
    first = [distinct.where(F.col("_label") == c).orderBy(*order).limit(sample) for c in (0, 1)]
    total = F.sum("_bytes").over(Window.partitionBy("_label").orderBy(*order))
    taken = first[0].unionByName(first[1]).withColumn("_total", total)
    taken = settle(taken.where(F.col("_total") <= sample_bytes).select("_id", "_digest"))
    rows = rows.join(F.broadcast(taken), ["_id", "_digest"]).dropDuplicates(["_id", "_digest"])
    rows = rows.select("_text", "_label")
    found = rows.mapInArrow(_features, "blob binary").collect()
    return fit([row["blob"] for row in found], prior)


def score_toxicity(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``docs`` with ``toxicity``, between 0 and 1, from the whole text."""
    kept = [c for c in docs.columns if c != "toxicity"]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text = kept.index(text_column)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = [batch.column(i) for i in range(len(kept))]
            scores = pa.array(sent.value.score(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*columns, scores], [*kept, "toxicity"])

    rows = docs.select(*kept)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(score, ", ".join([*fields, "toxicity double"]))
