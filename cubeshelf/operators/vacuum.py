"""Retention: old catalog snapshots and staging that nobody reads any more.

A run that hasn't ended holds a lease on the catalog commit that it was
planned on (its journal names it), so a run taken up again after weeks still
finds it. Readers without a journal have `grace_s` seconds: nothing younger is
removed.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..session import STAGING, shared_root
from ..sources import catalog_store, fs

KEEP, GRACE_S = 10, 7 * 24 * 3600


def leased_commits(spark: SparkSession, root: str) -> set[int]:
    """Commits that runs without an end were planned on."""
    held = set()
    for run in fs.list_dirs(spark, f"{root}/runs"):
        marks = f"{root}/runs/{run}/_journal"
        if fs.exists(spark, f"{marks}/clean.json"):
            continue
        plan = fs.read_text(spark, f"{marks}/plan.json")
        base = json.loads(plan)["base"] if plan else None
        if base is not None:
            held.add(int(base))
    return held


def vacuum_catalog(spark: SparkSession, root: str, keep: int = KEEP, grace_s: float = GRACE_S) -> list[str]:
    """Remove the snapshots behind the last `keep` commits, but for leased and
    young ones, and snapshots that no commit names (of writers that died);
    the names of those removed. The newest commit always stays."""
    root = root.rstrip("/")
    catalog, leased = f"{root}/catalog", leased_commits(spark, root)
    numbers = catalog_store.commits(spark, catalog)
    kept = set(numbers[-max(1, keep):]) | leased
    named = {n: catalog_store.snapshot_path(spark, catalog, n).rsplit("/", 1)[1] for n in numbers}
    stays = {named[n] for n in kept & set(numbers)}
    if not numbers or 0 in leased:  # a catalog from before the commits
        stays.add(catalog_store.uncommitted(spark, catalog))
    removed = []
    for name, age in sorted(fs.ages(spark, catalog).items()):
        if name.startswith("v=") and name not in stays and age >= grace_s:
            # the commit goes first: a reader finds a commit with its snapshot, or neither
            for n in (n for n, snapshot in named.items() if snapshot == name):
                fs.delete(spark, f"{catalog}/{catalog_store.COMMITS}/{n:020d}.json")
            fs.delete(spark, f"{catalog}/{name}")
            removed.append(name)
    return removed


def vacuum_staging(spark: SparkSession, grace_s: float = GRACE_S) -> list[str]:
    """Remove the staging of other applications that have written nothing for
    `grace_s` seconds; their names."""
    base, own = f"{shared_root(spark)}/{STAGING}", spark.sparkContext.applicationId
    removed = []
    for app, age in sorted(fs.ages(spark, base).items()):
        newest = min([age, *fs.ages(spark, f"{base}/{app}").values()])
        if app != own and newest >= grace_s:
            fs.delete(spark, f"{base}/{app}")
            removed.append(app)
    return removed
