"""Conversations as marked-up training text, and back again, in Spark expressions only.

A conversation is its turns in order; neighbouring turns of one role share one block::

    <|im_start|>role
    text<|im_sep|>text<|im_end|>

``<|im_sep|>`` parts the texts of merged turns, so merging loses nothing. In roles and texts
``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|`` (and a line break in a role ``&#10;``),
so no text can form a mark and reading back restores every character. The loss mask covers
the texts of one role, one span per turn: pairs of start and end counted in characters.

Results for unusual input: a null text or role is empty; turns are ordered by turn, then role,
then text, null turns first; repeated rows are all kept; null ids form one conversation; an
empty table gives no rows; other columns are ignored. A conversation is one output value, so
its turns are gathered, and only they.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column, line_breaks: bool = False) -> Column:
    """``text`` without anything that reads as a mark."""
    out = F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))
    return F.replace(out, F.lit("\n"), F.lit("&#10;")) if line_breaks else out


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`."""
    out = F.replace(F.replace(text, F.lit("&#10;"), F.lit("\n")), F.lit("&lt;|"), F.lit("<|"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def format_conversations(
    turns: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    loss_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans``, an array of
    (start, stop) in characters of ``formatted``."""
    said = turns.select(
        F.col(id_column),
        F.struct(
            F.col(turn_column).alias("turn"),
            F.coalesce(F.col(role_column), F.lit("")).alias("role"),
            F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        ).alias("said"),
    )
    gathered = said.groupBy(id_column).agg(F.sort_array(F.collect_list("said")).alias("turns"))
    counted = gathered.withColumn("count", F.size("turns"))

    def piece(turn: Column, i: Column) -> Column:
        # what stands before, inside and after the text of turn i
        same_before = (i > 0) & (F.get(F.col("turns"), i - 1)["role"] == turn["role"])
        same_after = (i + 1 < F.col("count")) & (
            F.get(F.col("turns"), i + 1)["role"] == turn["role"]
        )
        opening = F.concat(F.lit(START), escape(turn["role"], True), F.lit("\n"))
        return F.struct(
            F.when(same_before, F.lit(SEPARATOR)).otherwise(opening).alias("before"),
            escape(turn["text"]).alias("text"),
            F.when(same_after, F.lit("")).otherwise(F.lit(END + "\n")).alias("after"),
            (turn["role"] == loss_role).alias("loss"),
        )

    def extend(state: Column, part: Column) -> Column:
        start = state["length"] + F.length(part["before"])
        stop = start + F.length(part["text"])
        span = F.struct(start.alias("start"), stop.alias("stop"))
        return F.struct(
            (stop + F.length(part["after"])).alias("length"),
            F.when(part["loss"], F.concat(state["spans"], F.array(span)))
            .otherwise(state["spans"])
            .alias("spans"),
        )

    none = F.struct(
        F.lit(0).alias("length"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("spans")
    )
    pieces = counted.select(id_column, F.transform("turns", piece).alias("pieces"))
    return pieces.select(
        id_column,
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["before"], p["text"], p["after"])), ""
        ).alias("formatted"),
        F.aggregate("pieces", none, extend)["spans"].alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        body = F.substring(block, len(START) + 1, F.length(block))
        role = F.substring_index(body, "\n", 1)
        texts = F.split(F.substring(body, F.length(role) + 2, F.length(body)), r"<\|im_sep\|>")
        return F.transform(
            texts, lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, in order and with nothing between."""
    parts = F.transform(
        spans,
        lambda s: unescape(F.substring(formatted, s["start"] + 1, s["stop"] - s["start"])),
    )
    return F.array_join(parts, "")
