"""Missing-value tokens of text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The tokens the pandas CSV reader documents as missing by default.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def normalise_missing(
    df: DataFrame, columns: list[str], tokens: tuple[str, ...] = MISSING_TOKENS
) -> DataFrame:
    """Turn missing tokens in text columns into nulls."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in columns}
    )
