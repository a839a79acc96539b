"""Which columns each dataset had after each run.

Every run that publishes writes `schemas/run=<run>/` once: one row for each of its
datasets with the output columns in order. Tables are declared from the
newest row of a dataset, without listing its folder or reading a footer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SCHEMA_HISTORY
from . import fs

FOLDER = "schemas"


def _run_path(history: str, run: str) -> str:
    return f"{history}/run={run.rstrip('/').rsplit('/', 1)[-1]}"


def record(report: DataFrame, items: DataFrame, history: str, run: str, as_of: str) -> None:
    """Write the columns of a run's datasets, unless they are written.
    `report`: rows of published datasets; `items` names their folders."""
    spark, path = report.sparkSession, _run_path(history, run)
    if fs.exists(spark, f"{path}/_SUCCESS"):
        return
    folders = items.select(F.col("productId").alias("_id"), "folder")
    rows = report.join(folders, F.col("productId") == F.col("_id"))
    rows = rows.select("productId", "folder", F.lit(as_of).cast("timestamp").alias("as_of"),
                       F.from_json("columns", T.ArrayType(T.StringType())).alias("columns"))
    rows.write.mode("overwrite").parquet(path)


def of_run(spark: SparkSession, history: str, run: str) -> DataFrame:
    return spark.read.schema(SCHEMA_HISTORY).parquet(_run_path(history, run))


def read(spark: SparkSession, history: str) -> DataFrame:
    """(productId, folder, as_of, columns, run) of all runs; empty before the first."""
    schema = T.StructType([*SCHEMA_HISTORY.fields, T.StructField("run", T.StringType())])
    if not fs.exists(spark, history):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(history)


def latest(rows: DataFrame, keys=("productId", "folder")) -> DataFrame:
    """The newest of `rows` for each key."""
    newest = rows.groupBy(*keys).agg(F.max(F.struct("as_of", "run", "columns")).alias("r"))
    return newest.select(*keys, "r.as_of", "r.columns", "r.run")


def changes(rows: DataFrame) -> DataFrame:
    """(productId, run, change, column, was): what a dataset's columns are
    against its run before, in one row for each column that is `added`,
    `gone`, `renamed` (another name at the same place, both new to the other
    side) or `moved` (the same name at another place)."""
    before = F.lag("columns").over(Window.partitionBy("productId").orderBy("as_of", "run"))
    both = rows.select("productId", "run", "columns", before.alias("old")).where(F.col("old").isNotNull() & (F.col("old") != F.col("columns")))
    new = lambda c, other: ~F.array_contains(other, c)
    place = F.explode(F.sequence(F.lit(0), F.greatest(F.size("columns"), F.size("old")) - 1)).alias("i")
    at = both.select("productId", "run", "columns", "old", place).select("*", F.get("columns", "i").alias("c"), F.get("old", "i").alias("o"))
    fresh, left = F.col("c").isNotNull() & new(F.col("c"), F.col("old")), F.col("o").isNotNull() & new(F.col("o"), F.col("columns"))
    row = lambda change, column, was: F.struct(F.lit(change).alias("change"), column.alias("column"), was.cast("string").alias("was"))
    none = F.lit(None).cast("string")
    found = F.array(
        F.when(fresh & left, row("renamed", F.col("c"), F.col("o"))),
        F.when(fresh & ~left, row("added", F.col("c"), none)),
        F.when(left & ~fresh, row("gone", F.col("o"), none)),
        F.when(F.col("c").isNotNull() & ~fresh & ~F.col("c").eqNullSafe(F.col("o")),
               row("moved", F.col("c"), (F.array_position("old", F.col("c")) - 1))))
    return (at.select("productId", "run", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x"))
            .select("productId", "run", "x.change", "x.column", "x.was"))

