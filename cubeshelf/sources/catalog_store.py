"""The stored catalog: snapshots and numbered commits.

A snapshot is never overwritten in place: a job that reads the current
catalog and writes the refreshed one would otherwise delete its own input.
Each write goes to a new `v=<stamp>-<uuid>` folder and becomes the catalog by a
commit file, `_commits/<number>.json`, that names it. Numbers are taken one by
one and each once, so two refreshes that end together are both in the catalog.
Readers take the snapshot of the highest number. (`_latest/pointer.txt` is the
older form; it is read where there are no commits.)
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fs

POINTER, COMMITS = "_latest", "_commits"
_COMMIT = re.compile(r"(\d{20})\.json")


def is_missing_path(err: Exception) -> bool:
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if callable(cond) else None
    return name == "PATH_NOT_FOUND" or (name is None and "PATH_NOT_FOUND" in str(err))


def read_optional(spark: SparkSession, path: str, schema: T.StructType | None, fmt: str = "parquet") -> DataFrame:
    """Read `path`; when it does not exist (first run) return an empty frame
    of `schema`. Every other error propagates: a transient read failure must
    not make every dataset look new."""
    try:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(path)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        return spark.createDataFrame([], schema or T.StructType([]))


def commits(spark: SparkSession, catalog_dir: str) -> list[int]:
    """The numbers of all commits, ascending."""
    names = (_COMMIT.fullmatch(n) for n in fs.list_files(spark, f"{catalog_dir}/{COMMITS}"))
    return [int(m[1]) for m in names if m]


def _commit(spark: SparkSession, catalog_dir: str, n: int) -> dict:
    return json.loads(fs.read_text(spark, f"{catalog_dir}/{COMMITS}/{n:020d}.json"))


def uncommitted(spark: SparkSession, catalog_dir: str) -> str | None:
    """The current snapshot of a catalog without commits."""
    text = fs.read_text(spark, f"{catalog_dir}/{POINTER}/pointer.txt")
    if text is not None and text.strip():
        return text.strip()
    # a lost pointer is no first run: the newest complete snapshot stands
    for name in reversed(fs.list_dirs(spark, catalog_dir)):
        if name.startswith("v=") and fs.exists(spark, f"{catalog_dir}/{name}/_SUCCESS"):
            return name
    return None


def latest_commit(spark: SparkSession, catalog_dir: str) -> int | None:
    """The number of the newest commit; 0 for a snapshot from before the first
    one (an older catalog, or one whose commits are lost), None for no catalog."""
    found = commits(spark, catalog_dir)
    if found:
        return found[-1]
    return None if uncommitted(spark, catalog_dir) is None else 0


def snapshot_path(spark: SparkSession, catalog_dir: str, commit: int | None) -> str | None:
    if commit is None:
        return None
    name = _commit(spark, catalog_dir, commit)["snapshot"] if commit else uncommitted(spark, catalog_dir)
    return f"{catalog_dir}/{name}"


def latest_version(spark: SparkSession, catalog_dir: str) -> str | None:
    """The current snapshot folder name; None before the first write."""
    path = snapshot_path(spark, catalog_dir, latest_commit(spark, catalog_dir))
    return path and path.rsplit("/", 1)[1]


def read_commit(spark: SparkSession, catalog_dir: str, commit: int | None, schema: T.StructType) -> DataFrame:
    """The catalog as of a commit; an empty frame for None (first run). A
    commit whose snapshot is missing is damage, not a first run: it fails
    rather than treat every dataset as new."""
    path = snapshot_path(spark, catalog_dir, commit)
    return spark.createDataFrame([], schema) if path is None else spark.read.schema(schema).parquet(path)


def read_catalog(spark: SparkSession, catalog_dir: str, schema: T.StructType) -> DataFrame:
    """The latest stored catalog, or an empty frame on the first run."""
    return read_commit(spark, catalog_dir, latest_commit(spark, catalog_dir), schema)


def commit_of(spark: SparkSession, catalog_dir: str, note: str, since: int | None = None) -> str | None:
    """The snapshot that was committed under `note` after commit `since`, if any."""
    for n in reversed(commits(spark, catalog_dir)):
        if n <= (since or 0):
            break
        found = _commit(spark, catalog_dir, n)
        if found.get("note") == note:
            return f"{catalog_dir}/{found['snapshot']}"
    return None


def with_news(fresh: DataFrame, theirs: DataFrame, base: DataFrame, key: str = "productId") -> DataFrame:
    """`fresh` with the datasets that another commit has brought since `base`:
    they aren't gone from the listing, this run's listing is older. They come
    behind its own, in their order."""
    news = theirs.join(base.select(key), key, "left_anti").join(fresh.select(key), key, "left_anti")
    if "ordinal" in fresh.columns:
        last = fresh.agg(F.coalesce(F.max("ordinal") + 1, F.lit(0)).alias("_last"))
        news = news.crossJoin(F.broadcast(last)).withColumn("ordinal", F.col("ordinal") + F.col("_last"))
    return fresh.unionByName(news.select(fresh.columns))


def commit(spark: SparkSession, catalog_dir: str, build: Callable[[DataFrame, DataFrame | None], DataFrame],
           schema: T.StructType, base: int | None, note: str = "") -> str:
    """Write and commit a new snapshot; returns its path.

    `build(stored, planned_on)` gives its rows from the stored ones. Where
    others have committed since `base`, `stored` is the newest and
    `planned_on` the catalog at `base` (else None). Commits are numbered; a
    number is taken by creating its file, which one writer only can. Whoever
    comes second reads the newest catalog and merges anew, so no commit is
    lost."""
    while True:
        now = latest_commit(spark, catalog_dir)
        stored = read_commit(spark, catalog_dir, now, schema)
        rows = build(stored, None if now == base else read_commit(spark, catalog_dir, base, schema))
        name = f"v={dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        rows.write.mode("errorifexists").parquet(f"{catalog_dir}/{name}")
        entry = json.dumps({"snapshot": name, "note": note, "base": base})
        if fs.create_new(spark, f"{catalog_dir}/{COMMITS}/{(now or 0) + 1:020d}.json", entry.encode()):
            return f"{catalog_dir}/{name}"
        fs.delete(spark, f"{catalog_dir}/{name}")  # never seen by a reader


def write_catalog(df: DataFrame, catalog_dir: str) -> str:
    """Commit `df` as the new catalog, whatever stands there. Returns its path."""
    return commit(df.sparkSession, catalog_dir, lambda stored, planned_on: df, df.schema, None)
