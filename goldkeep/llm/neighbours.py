"""Nearest vectors by inner product through an index of binary codes.

Vectors are turned by learned rotations and coded by the signs of their coordinates, so the
Hamming distance of two codes follows the angle between the vectors. Vectors of unequal length
are first given a coordinate more that makes them equally long, which turns the largest inner
product into the smallest angle. A code is cut into substrings and each substring is indexed.
Two codes within a radius r agree within r // m bits in at least one of m substrings
(pigeonhole), so probing all substring values that near retrieves every code within the radius.
What is retrieved is checked on the whole code and ranked by the original vectors.

The rotations are fitted on at most ``SAMPLE`` vectors. The radius is the one that holds
``COVERAGE`` of the true neighbours of at most ``PROBES`` vectors, found by comparing those with
all rows; it is measured on the data that are searched. A query that finds fewer than k rows
within the radius is searched again with all rows as candidates.

Every row is indexed, in the task that reads it; queries go to the tasks in blocks of at most
``BLOCK``. Of equal vectors only the k + 1 smallest distinct ids, and k rows of each, can be among
the nearest, so no more are kept.

Results for unusual input: vectors that are null, zero, hold null or non-finite components, or
have another length than most, take no part; ties fall to the smaller id; rows that share the
query's id are not its neighbours; other rows that repeat an id are ranked one by one; null ids
take no part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldkeep.shared import settle

#: Most vectors the rotations are fitted on, and the radius.
SAMPLE, PROBES = 10_000, 200
#: Share of true neighbours inside the radius.
COVERAGE = 0.96
#: Bits of a code at least, bits of a substring at most, queries sent at once.
BITS, PART_BITS, BLOCK = 256, 16, 16_384


@dataclass
class Codes:
    """Learned codes: ``rotation`` maps a lengthened vector to its coordinates."""

    rotation: np.ndarray
    longest: float

    @property
    def bounds(self) -> np.ndarray:
        bits = self.rotation.shape[1]
        return np.linspace(0, bits, -(-bits // PART_BITS) + 1).astype(int)

    def bits(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        square = (vectors * vectors).sum(1)
        extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.longest**2 - square, 0))
        return np.column_stack([vectors, extra]) @ self.rotation > 0

    def parts(self, bits: np.ndarray) -> np.ndarray:
        """Substrings of codes as numbers, one column each."""
        out = np.zeros((len(bits), len(self.bounds) - 1), np.uint16)
        for j, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            for bit in range(a, b):
                out[:, j] = (out[:, j] << 1) | bits[:, bit]
        return out


def learn(vectors: np.ndarray, longest: float, bits: int = BITS, rounds: int = 20) -> Codes:
    """Rotations under which the signs of ``vectors`` lie close to their coordinates."""
    square = (vectors * vectors).sum(1)
    x = np.column_stack([vectors, np.sqrt(np.maximum(longest**2 - square, 0))])
    dims = x.shape[1]
    made = []
    for seed in range(-(-bits // dims)):
        start = np.random.default_rng(seed).standard_normal((dims, dims))
        rotation = np.linalg.qr(start)[0]
        for _ in range(rounds if len(x) else 0):
            u, _, v = np.linalg.svd(np.where(x @ rotation > 0, 1.0, -1.0).T @ x)
            rotation = v.T @ u.T
        made.append(rotation)
    return Codes(np.concatenate(made, 1), longest)


class Index:
    """Codes of some rows, every substring with its values and the rows of each."""

    def __init__(self, codes: Codes, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.parts = codes.parts(codes.bits(vectors, query=False))
        self.lists = []
        for j in range(self.parts.shape[1]):
            order = np.argsort(self.parts[:, j], kind="stable")
            values, first = np.unique(self.parts[order, j], return_index=True)
            self.lists.append((values, np.append(first, len(order)), order))

    def within(self, parts: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius`` of the code with these substrings."""
        near = radius // len(self.lists)
        found = np.zeros(len(self.ids), bool)
        for (values, first, order), value in zip(self.lists, parts):
            hit = np.flatnonzero(np.bitwise_count(values ^ value) <= near)
            # neighbouring values have neighbouring rows: copy stretches
            mark = np.zeros(len(order) + 1, np.int64)
            mark[first[hit]] += 1
            mark[first[hit + 1]] -= 1
            found[order[np.cumsum(mark[:-1]) > 0]] = True
        rows = np.flatnonzero(found)
        distance = np.bitwise_count(self.parts[rows] ^ parts).sum(1, dtype=np.int64)
        return rows[distance <= radius]

    def nearest(self, row_id: int, vector: np.ndarray, rows: np.ndarray, k: int):
        """The ``k`` nearest among ``rows``: their numbers and inner products."""
        rows = rows[self.ids[rows] != row_id]
        score = (self.vectors[rows] * vector).sum(1)
        if len(rows) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            keep = score >= least
            rows, score = rows[keep], score[keep]
        order = np.lexsort((self.ids[rows], -score))[:k]
        return rows[order], score[order]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)


def _search(codes, queries, dims: int, k: int):
    """Task function: rows in; the nearest of them to each query out. Each query brings its
    own radius; ``distance`` is that of the codes."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), _matrix(b.column(1), dims)) for b in batches]
        held = [h for h in held if len(h[0])]
        if not held:
            return
        code = codes.value
        ids, vectors = (np.concatenate(part) for part in zip(*held))
        index = Index(code, ids, vectors)
        own, asked, radius = queries.value
        parts = code.parts(code.bits(asked, query=True))
        out = [[], [], [], []]
        for i in range(len(own)):
            rows = index.within(parts[i], int(radius[i]))
            rows, score = index.nearest(own[i], asked[i], rows, k)
            distance = np.bitwise_count(index.parts[rows] ^ parts[i]).sum(1, dtype=np.int64)
            for column, part in zip(out, (np.full(len(rows), own[i]), ids[rows], score, distance)):
                column.append(part)
        columns = [pa.array(np.concatenate(c)) for c in out]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score", "distance"])

    return search


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """``id``, ``vector`` of the rows that take part, and the number of components."""
    vector = F.col(vector_column).cast("array<double>")
    good = vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).where(
        "id is not null and vector is not null and size(vector) > 0 "
        "and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        "and exists(vector, x -> x <> 0)"
    )
    lengths = good.groupBy(F.size("vector").alias("n")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    dims = most["n"] if most else 0
    return good.where(F.size("vector") == dims), dims


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of the ``k`` nearest rows to every
    row of ``is_query``, a condition on the column ``id``."""
    spark = vectors.sparkSession
    rows, dims = usable(vectors, id_column, vector_column)
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # a query passes over its own id: of equal vectors k rows of each of the first k + 1 ids are
    # enough; both limits apply before the shuffle
    repeats = Window.partitionBy("vector", "id").orderBy("id")
    rows = rows.withColumn("copy", F.row_number().over(repeats)).where(F.col("copy") <= k)
    equal = Window.partitionBy("vector").orderBy("id")
    rows = rows.withColumn("copy", F.dense_rank().over(equal)).where(F.col("copy") <= k + 1)
    rows = settle(rows.drop("copy"))
    queries = settle(rows_of_queries(vectors, is_query, id_column, vector_column, dims))

    longest, count = rows.agg(
        F.max(F.expr("aggregate(vector, 0D, (s, x) -> s + x * x)")), F.count(F.lit(1))
    ).first()
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
    sample = _matrix(drawn["vector"].combine_chunks(), dims)
    codes = learn(sample, float(np.sqrt(longest)))
    sent = spark.sparkContext.broadcast(codes)
    bits = codes.rotation.shape[1]

    def run(block: pa.Table, radius: int) -> DataFrame:
        own, asked = block["id"].to_numpy(), _matrix(block["vector"].combine_chunks(), dims)
        held = spark.sparkContext.broadcast((own, asked, np.full(len(own), radius)))
        found = rows.mapInArrow(
            _search(sent, held, dims, k), "query_id long, vec_id long, score double, distance long"
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    probes = queries.orderBy(F.xxhash64("id"), "id").limit(PROBES).toArrow()
    if not probes.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    true = run(probes, bits).select("distance").toArrow()["distance"].to_numpy()
    radius = int(np.quantile(true, COVERAGE, method="higher")) if len(true) else bits

    parts = -(-queries.count() // BLOCK)
    results = []
    for part in range(parts):
        mine = queries.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part)
        block = mine.toArrow()
        found = settle(run(block, radius))
        enough = found.groupBy("query_id").count().where(F.col("count") >= min(k, count - 1))
        few = mine.join(enough, mine["id"] == enough["query_id"], "left_anti").toArrow()
        if few.num_rows:
            other = run(few, bits)
            short = [i for i in few["id"].to_pylist()]
            found = found.join(
                F.broadcast(spark.createDataFrame([(i,) for i in short], "query_id long")),
                "query_id", "left_anti",
            ).unionByName(other)
        results.append(found)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def rows_of_queries(vectors, is_query, id_column, vector_column, dims: int) -> DataFrame:
    """The queries among the rows that take part; a repeated id asks once."""
    rows, _ = usable(vectors, id_column, vector_column)
    asked = rows.where((F.size("vector") == dims) & is_query)
    return asked.groupBy("id").agg(F.min("vector").alias("vector"))
