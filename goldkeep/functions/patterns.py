"""Wildcard patterns of access rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def wildcard_regex(pattern: str) -> str:
    """A regular expression for a pattern where ``*`` is any text and ``?`` one character."""
    parts = {"*": ".*", "?": "."}
    return "(?s)^" + "".join(parts.get(c) or re.escape(c) for c in pattern) + "$"


def wildcard_column(pattern: Column) -> Column:
    """The same for a column of patterns, in the quoting of the JVM."""
    quoted = F.replace(pattern, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    quoted = F.replace(quoted, F.lit("*"), F.lit("\\E.*\\Q"))
    quoted = F.replace(quoted, F.lit("?"), F.lit("\\E.\\Q"))
    return F.concat(F.lit("(?s)^\\Q"), quoted, F.lit("\\E\\z"))


def literal_head(pattern: Column) -> Column:
    """What stands before the first wildcard."""
    return F.regexp_extract(pattern, "^[^*?]*", 0)
