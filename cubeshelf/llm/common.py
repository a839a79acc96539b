"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeshelf.session import staging_dir

# The upper-case and lower-case ASCII letters; other letters are left alone.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without(df: DataFrame, names) -> list[Column]:
    """Columns of `df` whose names don't clash with `names` (any case)."""
    taken = {n.lower() for n in names}
    return [F.col(quoted(c)) for c in df.columns if c.lower() not in taken]


def staged(df: DataFrame, purpose: str, by: str | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back. Later steps
    start from these files, so a lost executor never recomputes what stands
    before them, and both sides of a later join are plain shuffles that
    adaptive execution can split when a key is hot. With `by`, files are laid
    out by that column, and a filter on it reads only its own."""
    path = staging_dir(df.sparkSession, purpose)
    out = df.write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether a row belongs to the held-out fold: crc32 of the id as text.
    A null id counts as an empty text."""
    crc = F.crc32(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).cast("binary"))
    return (crc % modulus) == remainder


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two columns that identify a row by id and text. Rows equal in both are
    copies of one row and get equal results from every operator."""
    return [F.col(quoted(id_col)).alias("key_id"),
            F.xxhash64(F.coalesce(F.col(quoted(text_col)), F.lit(""))).alias("key_hash")]
