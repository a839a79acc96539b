"""The journal of a run: what has ended, so that a run can be taken up again.

A run folder holds the run's settings, its written hand-offs and one mark for
each step that has ended, with the step's small facts (counts, paths). A mark
is written last, in one rename, so a step without one may have left anything
behind: it is run again, and its half-written hand-offs are replaced. Hand-offs
that stand (their writer's `_SUCCESS` is there) are read back, also by the
steps of another process.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import fs

MARKS, SETTINGS = "_journal", "settings.json"


class RunStopped(RuntimeError):
    """A run was stopped on request; `run` can be resumed."""

    def __init__(self, run: str, step: str):
        super().__init__(f"stopped after {step}; resume with {run}")
        self.run, self.step = run, step


class Journal:
    def __init__(self, spark: SparkSession, run: str):
        self.spark, self.run = spark, run.rstrip("/")

    # settings

    def save_settings(self, settings) -> None:
        fs.write_text(self.spark, f"{self.run}/{SETTINGS}", json.dumps(dataclasses.asdict(settings)))

    def settings(self) -> dict:
        text = fs.read_text(self.spark, f"{self.run}/{SETTINGS}")
        if text is None:
            raise FileNotFoundError(f"no run to resume: {self.run}/{SETTINGS}")
        return json.loads(text)

    # hand-offs

    def path(self, name: str) -> str:
        return f"{self.run}/{name}"

    def table(self, name: str, make: Callable[[], DataFrame], fmt: str = "parquet", **options) -> DataFrame:
        """The hand-off `name`, written by `make` unless it stands already."""
        path = self.path(name)
        if not fs.exists(self.spark, f"{path}/_SUCCESS"):
            fs.delete(self.spark, path)
            make().write.options(**options).format(fmt).save(path)
        return self.read(name) if fmt == "parquet" else self.spark.read.options(**options).format(fmt).load(path)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def forget(self, *names: str) -> None:
        """Remove hand-offs of a step that is run again."""
        for name in names:
            fs.delete(self.spark, self.path(name))

    # steps

    def facts(self, step: str) -> dict | None:
        """What a step that has ended noted; None before it has."""
        text = fs.read_text(self.spark, f"{self.run}/{MARKS}/{step}.json")
        return None if text is None else json.loads(text)

    def mark(self, step: str, facts: dict) -> None:
        fs.write_text(self.spark, f"{self.run}/{MARKS}/{step}.json", json.dumps(facts, default=str))

    def step(self, name: str, work: Callable[[], dict | None]) -> dict:
        """Do `work` and mark it, unless it is marked; its facts either way."""
        known = self.facts(name)
        if known is None:
            known = work() or {}
            self.mark(name, known)
        return known
