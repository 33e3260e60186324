"""Repeated runs of lines, removed wherever they come again.

Every three consecutive lines of a document are a window, so windows overlap. A window is known
by the MD5 of its lines. A window that also stands earlier, in a document with a smaller id or
further up in the same one, is removed; the lines that such windows cover are merged into spans
per document and the document keeps what lies between its spans.

Windows are counted with map-side combination. The repeated ones go back to the documents as a
lookup whose hot keys are spread over all tasks, so a passage that everybody has piles up
nowhere.

Results for unusual input: a null text has no lines and stays null; a document of fewer lines
than a window loses none; a null id is the largest; rows equal in id and text are judged alike,
so neither removes the other; an empty table gives no rows; columns named like a result column
are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldkeep.operators.joins import attach, fits_broadcast, heaviest
from goldkeep.shared import settle

#: Lines of a window.
WINDOW = 3
ADDED = ("n_lines", "n_removed", "kept_text")


def _lines():
    return F.split(F.col("_text"), "\n")


def line_windows(docs: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """Place and hash of every window: ``_id``, ``_digest`` (of the text), ``_at``, ``_hash``."""
    texts = docs.select(
        F.col(id_column).alias("_id"),
        F.col(text_column).alias("_text"),
        F.xxhash64(text_column).alias("_digest"),
    )
    cut = texts.select("_id", "_digest", _lines().alias("_lines")).where(
        F.size("_lines") >= window
    )
    hashes = F.expr(
        f"transform(sequence(1, size(_lines) - {window - 1}), "
        f"i -> unhex(md5(array_join(slice(_lines, i, {window}), '\n'))))"
    )
    return cut.select("_id", "_digest", F.posexplode(hashes).alias("_at", "_hash"))


def repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """``_id``, ``_digest`` and ``_spans``, the (start, stop) of the lines to remove."""
    windows = line_windows(docs, id_column, text_column, window)
    # a null id is the largest
    place = F.struct(F.col("_id").isNull().alias("n"), "_id", "_digest", "_at")
    counted = windows.groupBy("_hash").agg(
        F.min(place).alias("_first"), F.count(F.lit(1)).alias("_times")
    )
    repeated = settle(counted.where("_times > 1"))
    lookup = repeated.select("_hash", "_first")
    small = fits_broadcast(lookup)
    # which windows are frequent is known from the counts
    heavy = None if small else heaviest(repeated, ["_hash"], "_times")
    found = attach(windows, lookup, {"_hash": "_hash"}, how="inner", small=small, heavy=heavy)
    later = found.where(place > F.col("_first"))
    # overlapping and touching windows of a document form one span
    row = Window.partitionBy("_id", "_digest").orderBy("_at")
    before = F.lag("_at").over(row)
    begins = F.when(before.isNull() | (F.col("_at") > before + window), 1).otherwise(0)
    spans = (
        later.select("_id", "_digest", "_at")
        .distinct()
        .withColumn("_begins", begins)
        .withColumn("_span", F.sum("_begins").over(row))
        .groupBy("_id", "_digest", "_span")
        .agg(F.min("_at").alias("start"), (F.max("_at") + window).alias("stop"))
    )
    return spans.groupBy("_id", "_digest").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_spans")
    )


def drop_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_removed`` and ``kept_text``."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    spans = repeated_spans(docs, id_column, text_column, window)
    # the table's own columns travel in one, so none can be mistaken for one of those used here
    rows = docs.select(
        F.struct(*kept).alias("_row"), F.col(id_column).alias("_own"), F.col(text_column).alias("_text")
    )
    same = rows["_own"].eqNullSafe(spans["_id"]) & (F.xxhash64(rows["_text"]) == spans["_digest"])
    found = rows.join(spans, same, "left").withColumn("_lines", _lines())
    # what lies before, between and behind the spans
    pieces = F.expr(
        "transform(sequence(0, size(_spans)), i -> slice(_lines, "
        "if(i = 0, 0, _spans[i - 1].stop) + 1, "
        "if(i = size(_spans), size(_lines), _spans[i].start) - if(i = 0, 0, _spans[i - 1].stop)))"
    )
    left = F.when(F.col("_spans").isNull(), F.col("_lines")).otherwise(F.flatten(pieces))
    lines = F.coalesce(F.size("_lines"), F.lit(0)).cast("long")
    whole = F.col("_spans").isNull()
    return found.withColumn("_left", left).select(
        "_row.*",
        F.when(F.col("_text").isNull(), 0).otherwise(lines).alias("n_lines"),
        F.when(whole, 0).otherwise(lines - F.size("_left")).cast("long").alias("n_removed"),
        F.when(whole, F.col("_text")).otherwise(F.array_join("_left", "\n")).alias("kept_text"),
    )
