"""Run manifests: what a run has done, so that it can go on after a failure.

A run is a folder ``_runs/<run id>`` with one small file per finished step.
The first record of a step stands (put if absent). Steps that wrote a table
record its version; while the run is unfinished the store keeps those
versions, so the run reads its own data whatever other runs write.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from strata.sources.paths import names, path_exists, put_if_absent, read_text, remove_path

RUNS, FINISHED = "_runs", "finished"


class RunFinishedError(RuntimeError):
    """The run has ended; its versions are no longer kept for it."""


class RunManifest:
    """The records of one run below ``uri``."""

    def __init__(self, spark: SparkSession, uri: str, run_id: str):
        if not run_id or "/" in run_id or run_id.startswith((".", "_")):
            raise ValueError(f"not a run id: {run_id!r}")
        self.spark, self.run_id, self.folder = spark, run_id, f"{uri}/{RUNS}/{run_id}"
        if path_exists(spark, f"{self.folder}/{FINISHED}"):
            raise RunFinishedError(f"run {run_id} is finished; start another or forget this one")

    def get(self, step: str) -> Any:
        """What was recorded for ``step``, or None."""
        text = read_text(self.spark, f"{self.folder}/{step}.json")
        return json.loads(text) if text else None

    def put(self, step: str, record: Any) -> Any:
        """Record ``step`` as done; returns the record that stands."""
        if put_if_absent(self.spark, f"{self.folder}/{step}.json", json.dumps(record)):
            return record
        return self.get(step)

    def finish(self) -> None:
        """The run needs its versions no longer."""
        put_if_absent(self.spark, f"{self.folder}/{FINISHED}", "")

    def forget(self) -> None:
        """Remove the records: the next run of this id starts anew."""
        remove_path(self.spark, self.folder)


def unfinished(spark: SparkSession, uri: str) -> list[str]:
    """Ids of the runs that have begun and not finished."""
    return [r for r in names(spark, f"{uri}/{RUNS}") if not path_exists(spark, f"{uri}/{RUNS}/{r}/{FINISHED}")]


def pinned(spark: SparkSession, uri: str) -> set[str]:
    """Versions that unfinished runs of the store may still read."""
    found = set()
    for run in unfinished(spark, uri):
        folder = f"{uri}/{RUNS}/{run}"
        records = [json.loads(read_text(spark, f"{folder}/{n}") or "null") for n in names(spark, folder) if n.endswith(".json") and not n.startswith(".")]
        found |= {r["version"] for r in records if isinstance(r, dict) and r.get("version")}
    return found
