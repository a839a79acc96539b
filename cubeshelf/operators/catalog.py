"""Catalog refresh: ingestion dates and availability flags.

Every id list is reduced to distinct ids and joined as a "mark" (left join +
presence flag). The id side is an aggregation on the key, so the catalog is
shuffled once on the key and AQE broadcasts the id side when it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cadence import timestamp_literal
from .planning import latest_dates

DATE = "last_ingestion_date"
AVAILABLE = "available"


def ensure_column(df: DataFrame, name: str = DATE, dtype: str = "timestamp") -> DataFrame:
    """Add an all-null column when it is absent."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def _marked(df: DataFrame, ids: DataFrame, key: str, id_col: str | None) -> DataFrame:
    hits = (ids.select(F.col(id_col or key).alias(key)).where(F.col(key).isNotNull())
            .distinct().withColumn("_hit", F.lit(True)))
    return df.join(hits, key, "left")


def merge_metadata(fresh: DataFrame, stored: DataFrame, key: str = "productId", date: str = DATE) -> DataFrame:
    """Fresh metadata wins; the stored ingestion date is carried over by key.

    Keys gone from `fresh` disappear, new keys get null. A date column already
    in `fresh` is dropped first (it would shadow the stored one), and
    duplicate stored keys keep their latest date, so rows never multiply.
    """
    f = fresh.drop(date) if date in fresh.columns else fresh
    if date not in stored.columns:
        return f.withColumn(date, F.lit(None).cast("timestamp"))
    dates = latest_dates(stored.select(key, date), key, date).drop("_stored")
    return f.join(dates, key, "left")


def stamp_dates(catalog: DataFrame, ids: DataFrame, ts, key: str = "productId", date: str = DATE,
                id_col: str | None = None) -> DataFrame:
    """Set `date` to `ts` for keys in `ids` (overwriting older values); other
    rows unchanged. Column order is kept."""
    catalog = ensure_column(catalog, date)
    ntz = isinstance(catalog.schema[date].dataType, T.TimestampNTZType)
    stamp = timestamp_literal(ts, like_ntz=ntz)
    j = _marked(catalog, ids, key, id_col)
    return j.select([F.when(F.col("_hit"), stamp).otherwise(F.col(date)).alias(date) if c == date else F.col(c)
                     for c in catalog.columns])


def mark_available(catalog: DataFrame, ids: DataFrame, key: str = "productId", flag: str = AVAILABLE,
                   id_col: str | None = None) -> DataFrame:
    """`flag` = key is among `ids` (never null). Recomputed for every row; an
    existing flag column is replaced in place."""
    j = _marked(catalog, ids, key, id_col)
    value = F.col("_hit").isNotNull().alias(flag)
    cols = [value if c == flag else F.col(c) for c in catalog.columns]
    if flag not in catalog.columns:
        cols.append(value)
    return j.select(cols)


def availability_summary(catalog: DataFrame, flag: str = AVAILABLE) -> DataFrame:
    """One row: available datasets out of all."""
    return catalog.agg(F.count_if(F.col(flag)).alias("n_available"), F.count(F.lit(1)).alias("n_total"))
