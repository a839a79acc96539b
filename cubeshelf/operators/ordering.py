"""Order-dependent operators: first row per key and running totals.

Both avoid windows that put a whole key (or the whole table) into one task:
`first_per_key` is an aggregation with map-side partial results, and
`running_total_before` is a two-level prefix sum over ranges of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The first row of each key when rows are sorted ascending by `order`.

    Implemented as `min(struct(order..., rest...))` per key: every map task
    keeps one candidate per key before the shuffle, so a key holding a third
    of the rows costs no more than any other key. Rows equal on all columns
    are interchangeable, so the result is deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    best = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return best.select([F.col(c) if c in keys else F.col("_first").getField(c).alias(c) for c in df.columns])


ROWS_PER_BLOCK = 1_000_000


def _ordered(df: DataFrame, order: str) -> list:
    """`order` ascending (nulls first), then all other columns, so that rows
    equal in `order` have one defined sequence too."""
    return [F.col(order).asc_nulls_first(), *[F.col(c) for c in df.columns if c != order]]


def running_total_before(df: DataFrame, value: str, order: str, out: str = "total_before",
                         n_blocks: int | None = None, input_written: bool = False) -> DataFrame:
    """Adds `out` = sum of `value` over all rows strictly before each row in
    `order` (0 for the first row). `order` may be of any type with an order;
    null comes first, and rows equal in it follow their other columns.

    Two-level prefix sum, the same at every size: rows are cut into ranges of
    `order` of about ROWS_PER_BLOCK rows, written with their range number
    (so a lost executor can't shift a boundary), summed within each range,
    and offset by the totals of the ranges before. Only one row per range
    meets in one task.
    """
    from ..session import materialize as write_once
    if not input_written:
        df = write_once(df, "running-total-input")
    if n_blocks is None:
        n_blocks = max(2, -(-df.count() // ROWS_PER_BLOCK))
    # ranges of the whole sequence: a value of `order` that many rows share is split as well
    blocked = write_once(df.repartitionByRange(n_blocks, *_ordered(df, order))
                         .withColumn("_blk", F.spark_partition_id()), "running-total-blocks")
    zero = F.lit(0).cast(df.schema[value].dataType)
    in_block = Window.partitionBy("_blk").orderBy(*_ordered(df, order)).rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy("_blk").agg(F.coalesce(F.sum(value), zero).alias("_blk_total"))
    # One row per range of a million rows: a single-partition window is fine here.
    offsets = totals.select(F.col("_blk").alias("_off_blk"), F.coalesce(
        F.sum("_blk_total").over(Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)), zero).alias("_blk_offset"))
    return (blocked.withColumn("_local", F.coalesce(F.sum(value).over(in_block), zero))
            .join(offsets, F.col("_blk") == F.col("_off_blk"))
            .select(*df.columns, (F.col("_blk_offset") + F.col("_local")).alias(out)))


TOPK_MAX = 100_000


def first_n(df: DataFrame, n: int, order: str, topk_max: int = TOPK_MAX) -> DataFrame:
    """The first `n` rows in `order` (nulls first, ties by the other columns).
    Up to `topk_max` a top-k: each task keeps k rows, then k rows per task
    are merged. Beyond it, holding k rows per task would not fit, so the rank
    comes from the two-level running count; the rows are the same."""
    if n <= 0:
        return df.limit(0)
    if n <= topk_max:
        return df.orderBy(*_ordered(df, order)).limit(int(n))
    ranked = running_total_before(df.withColumn("_one", F.lit(1).cast("long")), "_one", order, "_rank")
    return ranked.where(F.col("_rank") < F.lit(int(n))).drop("_one", "_rank")


def within_budget(df: DataFrame, size_mb: str, order: str, cap_mb: float,
                  out_total: str = "mb_before", out_flag: str = "started", input_written: bool = False) -> DataFrame:
    """Size cap: an item is started while the total of the items before it is
    below the cap, so the item that crosses the line is still included."""
    with_total = running_total_before(df, size_mb, order, out_total, input_written=input_written)
    return with_total.withColumn(out_flag, F.col(out_total) < F.lit(cap_mb))
