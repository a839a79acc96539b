"""Sizes in decimal megabytes / gigabytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from .._compat import as_col

BYTES_PER_MB = 1e6
MB_PER_GB = 1000.0


def mb(bytes_col):
    return as_col(bytes_col).cast("double") / F.lit(BYTES_PER_MB)


def gb_from_mb(mb_col):
    return as_col(mb_col) / F.lit(MB_PER_GB)
