"""Update planning: which datasets are new or due, and how much to take.

All joins are equi-joins on the dataset key. Both sides are first reduced to
one row per key by an aggregation, so the join reuses that hash partitioning
(no extra shuffle); AQE turns it into a broadcast join at runtime when one
side is measured to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cadence import is_due, days_between, frequency_days, timestamp_literal
from .ordering import TOPK_MAX, first_n, first_per_key

# Work-list reasons and the marker of hidden internal tables.
REASON_NEW = "new"
REASON_DUE = "update_due"
INVISIBLE_MARK = "INVISIBLE"


def _is_ntz(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.TimestampNTZType)


def latest_dates(stored: DataFrame, key: str = "productId", date: str = "last_ingestion_date") -> DataFrame:
    """One row per stored key: (key, date, _stored=true). Duplicate stored ids
    keep their latest date; a key whose dates are all null keeps null."""
    if date not in stored.columns:
        stored = stored.withColumn(date, F.lit(None).cast("timestamp"))
    return stored.groupBy(key).agg(F.max(date).alias(date), F.lit(True).alias("_stored"))


def classify(fresh: DataFrame, stored: DataFrame, as_of, key: str = "productId",
             order: str = "ordinal", title: str = "title", frequency: str = "frequency",
             date: str = "last_ingestion_date", mapping: dict[str, int] | None = None) -> DataFrame:
    """Work list: every fresh key that is new (absent from `stored`, or stored
    with a null date) or due (enough days since the stored date for the
    *fresh* frequency). Keys only in `stored` are ignored. When a fresh key
    repeats, its first row in `order` wins.

    Output: key, title, frequency, reason, order.
    """
    f = first_per_key(fresh.select(key, title, frequency, order), key, [order])
    s = latest_dates(stored.select(*[c for c in (key, date) if c in stored.columns]), key, date)
    now = timestamp_literal(as_of, like_ntz=_is_ntz(s, date))
    joined = f.join(s, key, "left")
    reason = (F.when(F.col("_stored").isNull() | F.col(date).isNull(), F.lit(REASON_NEW))
              .when(is_due(F.col(frequency), F.col(date), now, mapping), F.lit(REASON_DUE)))
    return (joined.select(key, title, frequency, reason.alias("reason"), order)
            .where(F.col("reason").isNotNull()))


def due_pairs(fresh: DataFrame, stored: DataFrame, as_of, key: str = "productId",
              order: str = "ordinal", frequency: str = "frequency", date: str = "last_ingestion_date",
              mapping: dict[str, int] | None = None) -> DataFrame:
    """Every fresh key that has a stored date, with elapsed days, the interval
    and the due flag (inspection view of the due test)."""
    s = latest_dates(stored.select(key, date), key, date).where(F.col(date).isNotNull())
    now = timestamp_literal(as_of, like_ntz=_is_ntz(s, date))
    f = first_per_key(fresh.select(key, frequency, order), key, [order]).drop(order)
    j = f.join(s.drop("_stored"), key, "inner")
    return j.select(key, frequency, date,
                    days_between(F.col(date), now).alias("elapsed_days"),
                    frequency_days(F.col(frequency), mapping).alias("interval_days"),
                    is_due(F.col(frequency), F.col(date), now, mapping).alias("due"))


def limit_new(work: DataFrame, limit: int | None, order: str = "ordinal", reason: str = "reason",
              topk_max: int = TOPK_MAX) -> DataFrame:
    """Keep the first `limit` new rows (in `order`) and every due row.

    None leaves the list unchanged; 0 keeps no new rows. Up to `topk_max` the
    limited branch is a top-k (per-task top-k, then a merge of k rows per
    task). Beyond it, holding k rows per task would not fit, so the rank
    comes from the two-level running count instead (no task holds more than
    one block). Both give the same rows.
    """
    if limit is None:
        return work
    new = first_n(work.where(F.col(reason) == REASON_NEW), int(limit), order, topk_max)
    return new.unionByName(work.where(F.col(reason) == REASON_DUE))


def reason_counts(work: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows per reason (partial aggregation before the shuffle)."""
    return work.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def plan_summary(before: DataFrame, after: DataFrame, reason: str = "reason") -> DataFrame:
    """One row: new before/after the limit and the number of due updates,
    from one aggregation over both lists (tagged and unioned)."""
    tagged = (before.select(F.col(reason), F.lit(True).alias("_before"))
              .unionByName(after.select(F.col(reason), F.lit(False).alias("_before"))))
    is_new, is_due = F.col(reason) == REASON_NEW, F.col(reason) == REASON_DUE
    return tagged.agg(F.count_if(F.col("_before") & is_new).alias("new_before"),
                      F.count_if(F.col("_before") & is_due).alias("update_due"),
                      F.count_if(~F.col("_before") & is_new).alias("new_after"),
                      F.count_if(~F.col("_before")).alias("total"))


def legacy_filter(catalog: DataFrame, existing_ids: DataFrame, skip_invisible: bool = True,
                  limit: int | None = None, key: str = "productId", title: str = "title",
                  order: str = "ordinal", id_col: str | None = None) -> DataFrame:
    """Catalog rows whose key is not among `existing_ids`, without hidden
    titles (a null title is kept), then the first `limit` rows in `order`.

    `limit` 0 or None means no limit. A null key is kept (it never matches).
    """
    ids = existing_ids.select(F.col(id_col or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    out = catalog.join(ids, key, "left_anti")
    if skip_invisible:
        out = out.where(~F.coalesce(F.col(title).contains(INVISIBLE_MARK), F.lit(False)))
    if limit:
        out = first_n(out, int(limit), order)
    return out


def worklist_join(catalog: DataFrame, work: DataFrame, key: str = "productId", reason: str = "reason") -> DataFrame:
    """Full catalog rows for the keys of the work list, with the reason.

    Semi join and left join of the reason collapse into one inner join with
    the work list reduced to one row per key."""
    w = work.groupBy(key).agg(F.min(reason).alias(reason))
    cat = catalog.drop(reason) if reason in catalog.columns else catalog
    return cat.join(w, key, "inner")


def id_membership(left: DataFrame, right: DataFrame, key: str = "productId",
                  right_key: str | None = None) -> DataFrame:
    """Set difference and intersection of two id sets in one join:
    (key, side) with side in {'left_only', 'both', 'right_only'}."""
    l_ids = left.select(F.col(key)).where(F.col(key).isNotNull()).distinct().withColumn("_l", F.lit(True))
    r_ids = (right.select(F.col(right_key or key).alias(key)).where(F.col(key).isNotNull())
             .distinct().withColumn("_r", F.lit(True)))
    j = l_ids.join(r_ids, key, "full_outer")
    side = (F.when(F.col("_l") & F.col("_r"), F.lit("both"))
            .when(F.col("_l"), F.lit("left_only")).otherwise(F.lit("right_only")))
    return j.select(key, side.alias("side"))
