"""Materialised intermediates in the folder all executors share.

Operators that use one small result several times (a crosswalk, a dimension, a list of
heavy keys) settle it first: the result is computed once, its lineage ends in reliable
storage, and a lost executor costs a re-read instead of a recomputation.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset it is a folder in
    the warehouse of the session, which executors share as well.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


#: Files of an intermediate for each core, and shuffle partitions that share one at least.
FILES_PER_CORE, PARTITIONS_PER_FILE = 4, 16


def settle(df: DataFrame, few: bool = False) -> DataFrame:
    """Compute ``df`` once and cut its lineage.

    ``few`` limits the tasks that write it, and so its files. Without Hadoop's native library
    a local file system starts a process for each file, which for a moment holds the whole memory
    of the executor a second time.
    """
    spark = df.sparkSession
    shared_folder(spark)
    if few:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        cores = spark.sparkContext.defaultParallelism
        df = df.coalesce(max(FILES_PER_CORE * cores, partitions // PARTITIONS_PER_FILE))
    return df.checkpoint()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder. See :func:`clear_scratch`."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def scratch_table(label: str) -> str:
    """A new, unused name of a catalog table. See :func:`clear_scratch`."""
    name = f"{label}_{uuid.uuid4().hex}"
    _NAMED.append(name)
    return name


#: Scratch paths and tables of this process that have not been removed.
_MADE: list[str] = []
_NAMED: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Remove what was written under scratch paths and names, and say how many there were.

    Results read from such paths are lazy, so nothing is removed by itself: call this when the
    results of the session have been written elsewhere.
    """
    removed = len(_MADE) + len(_NAMED)
    while _NAMED:
        spark.sql(f"drop table if exists {_NAMED.pop()}")
    while _MADE:
        remove_path(spark, _MADE.pop())
    return removed


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system ``path`` names."""
    system, where = _at(spark, path)
    return system.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all it holds, if it is there."""
    system, where = _at(spark, path)
    system.delete(where, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(where))


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file only if there is none, and say whether it was written.

    The file system decides between two who try at once: HDFS and stores with conditional
    writes let exactly one create a file.
    """
    system, where = _at(spark, path)
    try:
        stream = system.create(where, False)
    except Py4JJavaError as refused:
        if "AlreadyExists" not in refused.java_exception.getClass().getName():
            raise
        return False
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or nothing if it is gone."""
    system, where = _at(spark, path)
    if not system.exists(where):
        return None
    try:
        stream = system.open(where)
    except Py4JJavaError as gone:
        if "FileNotFound" not in gone.java_exception.getClass().getName():
            raise
        return None
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text
