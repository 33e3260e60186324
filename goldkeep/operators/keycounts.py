"""Row counts per key, kept over batches, so that checks do not read earlier batches again.

The counts of a batch are one partition of a bucketed table. A batch is added up before it is
shuffled, so a frequent key is one row per task, and lands in the buckets of its keys. Checks
group the table by key where it lies: only the batch has moved. Loading a batch again replaces its
partition and no other, so a load that was stopped can simply be repeated. Foreign keys can be
checked, remapped and checked again on the same layout.

Keys keep nulls. An empty batch has no counts, and replaces the counts it had. The table is read
as a whole by every check; :meth:`KeyCounts.merged_into` makes one partition of many.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files of a batch. Counts of all batches of one bucket are grouped in one task.
BUCKETS = 200


@dataclass(frozen=True)
class KeyCounts:
    """Counts of the values of ``keys`` in the catalog table ``name``."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    def load(self, batch: str, rows: DataFrame) -> None:
        """Count the keys of ``rows`` as ``batch``, in place of what that batch held."""
        counted = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_rows"))
        self._write(batch, counted)

    def _write(self, batch: str, counted: DataFrame) -> None:
        # dealt as the buckets are, so that each has one file
        dealt = counted.select(*self.keys, "_rows").repartition(self.buckets, *self.keys)
        if self.spark.catalog.tableExists(self.name):
            self.spark.sql(
                f"insert overwrite table {self.name} partition (_batch = {{batch}}) select * from {{dealt}}",
                batch=batch,
                dealt=dealt,
            )
        else:
            first = dealt.withColumn("_batch", F.lit(batch)).write.partitionBy("_batch")
            first.bucketBy(self.buckets, *self.keys).saveAsTable(self.name)

    def counts(self) -> DataFrame:
        """Every key once, with ``n_rows`` over all batches."""
        stored = self.spark.table(self.name).groupBy(*self.keys)
        return stored.agg(F.sum("_rows").alias("n_rows"))

    def pk_violations(self) -> DataFrame:
        """Keys that are repeated in or between batches or hold a null, with their row count."""
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.keys])
        return self.counts().where(missing | (F.col("n_rows") > 1))

    def key_ids(self) -> DataFrame:
        """The distinct keys of a table of one column, as ``id``."""
        (key,) = self.keys
        return self.counts().select(F.col(key).alias("id"))

    def fk_violations(self, parent: DataFrame, parent_key: str) -> DataFrame:
        """Non-null keys of a table of one column that no parent has, with their row count."""
        (key,) = self.keys
        counted = self.counts().where(F.col(key).isNotNull()).select(F.col(key).alias("id"), "n_rows")
        return counted.join(parent.select(F.col(parent_key).alias("id")), "id", "left_anti")

    def merged_into(self, name: str, batch: str) -> KeyCounts:
        """A new table that holds the counts of all batches as one."""
        merged = KeyCounts(self.spark, name, self.keys, self.buckets)
        merged._write(batch, self.counts().withColumnRenamed("n_rows", "_rows"))
        return merged
