"""Connected components by alternating large-star and small-star steps.

Each step is one aggregation (the smallest neighbour of a node, combined
before the shuffle) and one join. Edges and minima are written between the
steps: no lineage grows with the rounds, and the join of a hot node's edges
is a plain shuffle join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm.common import staged


def _oriented(e: DataFrame) -> DataFrame:
    """Edges as (u, v) with v < u, without loops and repeats."""
    return (e.where(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _stamp(e: DataFrame):
    r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(r)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select("v", "u").toDF("u", "v"))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = staged(low.select(F.col("u").alias("w"), F.least("u", "m").alias("m")), "large-star")
    j = both.where(F.col("v") > F.col("u")).join(low, F.col("u") == F.col("w"))
    return _oriented(j.select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    low = staged(e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"), "small-star")
    j = e.join(low, F.col("u") == F.col("w")).where(F.col("v") != F.col("m"))
    hung = j.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(hung.union(low.select(F.col("w").alias("u"), F.col("m").alias("v"))))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node that has an edge to another node; the
    component is its smallest node. Loops, repeats and edges with a null end
    are left out; no edges give no rows."""
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).dropna()
    e = staged(_oriented(e), "edges")
    stamp = _stamp(e)
    while stamp[0]:
        e = staged(_large_star(e), "edges")
        e = staged(_small_star(e), "edges")
        now = _stamp(e)
        if now == stamp:
            break
        stamp = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))))
