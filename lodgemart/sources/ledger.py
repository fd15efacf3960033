"""What a run has committed, so that a later run goes on from there.

Each written table gets an entry: stage, table, a digest of all that went into it, the version
that came out, its counts and a state. An entry is a file of its own that appears complete or
not at all, so the folder can be read as a table of JSON rows at any time.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from lodgemart.sources.staging import Files

STARTED, COMMITTED = "started", "committed"
SCHEMA = (
    "stage string, table string, inputs string, version string, counts string, state string, at_ms bigint"
)


def digest(parts: Iterable[str | None]) -> str:
    """One identity of several; a part that can't be told makes it one that is never met again."""
    known = [uuid.uuid4().hex if p is None else p for p in parts]
    return hashlib.sha256(json.dumps(known).encode()).hexdigest()


class Ledger:
    """Entries of the tables of one job; the last one of each table counts.

    With ``resume`` a step is left out if its last entry is committed, its inputs have the digest
    they had, and its table still is the version that was committed.
    """

    def __init__(self, spark: SparkSession, folder: str, resume: bool = False) -> None:
        self.spark, self.folder, self.resume = spark, folder.rstrip("/"), resume
        self.files, self.lock = Files(spark, folder), threading.Lock()
        self.redone: list[tuple[str, str]] = []
        self.last: dict[tuple[str, str], dict] = {}
        names: dict[tuple[str, str], list[str]] = {}
        if self.files.exists(self.folder) and any(n.endswith(".json") for n in self.files.names(self.folder)):
            # A few entries for each table of the job: older ones are removed below.
            for row in self.entries().selectExpr("*", "_metadata.file_name as file").orderBy("at_ms", "state").collect():
                entry = row.asDict()
                names.setdefault((entry["stage"], entry["table"]), []).append(entry["file"])
                self.last[entry["stage"], entry["table"]] = entry
        for files in names.values():
            for outdated in files[:-2]:
                self.files.delete(f"{self.folder}/{outdated}")

    def entries(self) -> DataFrame:
        """All entries as a table."""
        return self.spark.read.schema(SCHEMA).json(f"{self.folder}/*.json")

    def _log(self, stage: str, table: str, inputs: str, state: str, version: str | None, counts: Any) -> None:
        entry = {
            "stage": stage, "table": table, "inputs": inputs, "version": version,
            "counts": json.dumps(counts), "state": state, "at_ms": time.time_ns() // 1_000_000,
        }
        name = f"{stage}-{table}-{uuid.uuid4().hex}.json".replace("/", "_")
        self.files.write(f"{self.folder}/{name}", json.dumps(entry))
        with self.lock:
            self.last[stage, table] = entry

    def step(
        self, stage: str, table: str, inputs: Iterable[str | None], version: Callable[[], str | None], write: Callable[[], Any]
    ) -> Any:
        """What ``write`` returns, or returned when the table was committed as it still is."""
        key = digest(inputs)
        entry = self.last.get((stage, table))
        if self.resume and entry and entry["state"] == COMMITTED and entry["inputs"] == key:
            if entry["version"] and entry["version"] == version():
                return json.loads(entry["counts"])
        self._log(stage, table, key, STARTED, None, None)
        counts = write()
        self._log(stage, table, key, COMMITTED, version(), counts)
        with self.lock:
            self.redone.append((stage, table))
        return counts


class NoLedger:
    """Every step is done, nothing is recorded."""

    def step(self, stage: str, table: str, inputs: Any, version: Any, write: Callable[[], Any]) -> Any:
        return write()
