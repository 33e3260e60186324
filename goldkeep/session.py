"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that matter to the plans here; a cluster keeps its own values for the rest.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints are dropped once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, app: str = "goldkeep", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
