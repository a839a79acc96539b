"""Missing-value symbols of the statistical tables mapped to null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._compat import as_col, qcol

# Cells equal to one of these (exact, case-sensitive, untrimmed)
# are missing values.
NULL_SYMBOLS = [
    "",
    ".", "..", "...",
    "x", "X",
    "E", "e",
    "F", "f",
    "t", "T",
    "A", "B", "C", "D",
    "p", "r",
    "0s",
]


def null_symbol(c):
    """The cell, or null when it is a missing-value symbol."""
    c = as_col(c)
    return F.when(~c.isin(*NULL_SYMBOLS), c)


def map_null_symbols(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Apply `null_symbol` to `columns` (default: every column), keeping
    column order and names."""
    targets = set(df.columns if columns is None else columns)
    return df.select([null_symbol(qcol(c)).alias(c) if c in targets else qcol(c) for c in df.columns])
