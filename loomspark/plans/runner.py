"""Incremental stages: skip what is complete under the same fingerprint, recompute the rest."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = 1


def fingerprint(*inputs: object) -> str:
    """SHA-256 of canonical JSON (sorted keys, compact)."""
    return hashlib.sha256(json.dumps(inputs, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str).encode()).hexdigest()


def table_fingerprint(df: DataFrame) -> str:
    """Order-free content digest of a table, by one aggregation."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    return fingerprint(row.n, str(row.s), df.schema.simpleString())


#: Files up to this size are known by their content, larger ones by size and time of change.
CONTENT_BYTES = 128 << 20


def file_stamp(spark: SparkSession, path: str) -> dict:
    """What a file or folder is known by, on any file system that Spark reads; a missing one has a mark of its own."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(conf)
    if not files.exists(place):
        return {"path": path, "missing": True}
    status = files.getFileStatus(place)
    if status.isFile() and status.getLen() <= CONTENT_BYTES:
        content = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("d")).first()
        return {"path": path, "sha256": content.d}
    return {"path": path, "size": status.getLen(), "modified": status.getModificationTime()}


class Stage(NamedTuple):
    """A stage: what it depends on, what it leaves, and its work. `needs` names inputs that must be there before a run."""

    name: str
    stamp: Callable[[], str]
    outputs: Callable[[], bool]
    action: Callable[[], None]
    needs: Callable[[], list[str]] = list


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


class StageRunner:
    """Runs named stages in order and remembers their state in a JSON file on the driver. The file's keys are a fixed format."""

    def __init__(self, state_path: str, order: list[str], force: set[str] | None = None, dry_run: bool = False):
        self.path, self.order, self.force, self.dry_run = state_path, order, force or set(), dry_run
        if unknown := self.force - set(order):
            raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
        self.state = self._load()

    def _load(self) -> dict:
        fresh = {"schema_version": SCHEMA, "stages": {}}
        try:
            with open(self.path, encoding="utf-8") as file:
                found = json.load(file)
        except FileNotFoundError:
            return fresh
        except ValueError:
            found = None
        if isinstance(found, dict) and found.get("schema_version") == SCHEMA and isinstance(found.get("stages"), dict):
            return found
        os.replace(self.path, self.path + ".unreadable")
        return fresh

    def _mark(self, name: str, **entry: object) -> None:
        """Writes a stage's entry through to the disk before anything else happens."""
        self.state["stages"][name] = self.state["stages"].get(name, {}) | entry
        self.state["updated_at"] = _now()
        with open(self.path + ".next", "w", encoding="utf-8") as file:
            json.dump(self.state, file, ensure_ascii=False, sort_keys=True)
            file.flush()
            os.fsync(file.fileno())
        os.replace(self.path + ".next", self.path)

    def between(self, first: str | None = None, last: str | None = None) -> list[str]:
        """Stages of a range, both ends included."""
        a = self.order.index(first) if first else 0
        b = self.order.index(last) if last else len(self.order) - 1
        if a > b:
            raise ValueError(f"{first} comes after {last}")
        return self.order[a : b + 1]

    def fresh(self, name: str, stamp: str, outputs: Callable[[], bool]) -> bool:
        """Whether a stage need not run: complete under this stamp, its outputs there, and not forced."""
        known = self.state["stages"].get(name, {})
        return name not in self.force and (known.get("status"), known.get("fingerprint")) == ("complete", stamp) and outputs()

    def run(self, name: str, stamp: str, outputs: Callable[[], bool], action: Callable[[], None]) -> str:
        """skipped, planned (dry run) or complete. A stage that fails, is interrupted, or leaves no outputs is remembered as failed."""
        if self.fresh(name, stamp, outputs):
            return "skipped"
        if self.dry_run:
            return "planned"
        self.state["stages"].pop(name, None)
        self._mark(name, status="running", fingerprint=stamp, started_at=_now())
        try:
            action()
            if not outputs():
                raise RuntimeError(f"{name} left no outputs")
        except BaseException as error:
            self._mark(name, status="failed", error=f"{type(error).__name__}: {error}", failed_at=_now())
            raise
        self._mark(name, status="complete", completed_at=_now())
        return "complete"

    def run_all(self, stages: list[Stage], first: str | None = None, last: str | None = None) -> dict[str, str]:
        """Runs a range of stages. What a stage needs is looked for before any runs, except what an earlier one will make."""
        chosen = [s for s in stages if s.name in self.between(first, last)]
        if chosen and (gone := chosen[0].needs()):
            raise FileNotFoundError(f"{chosen[0].name} needs {', '.join(gone)}")
        done = {}
        for stage in chosen:
            if not self.dry_run and (gone := stage.needs()):
                raise FileNotFoundError(f"{stage.name} needs {', '.join(gone)}")
            done[stage.name] = self.run(stage.name, stage.stamp(), stage.outputs, stage.action)
        return done


def same_rows(output: DataFrame, source: DataFrame) -> None:
    """Refuses an output with another number of rows than its source."""
    got, expected = output.count(), source.count()
    if got != expected:
        raise ValueError(f"{got} rows instead of {expected}")


def cached_transform(rows: DataFrame, cache: DataFrame, key: str, payload: str, work: Callable[[list[str]], list[str]], batch: int = 32) -> DataFrame:
    """Results by key: from the cache where the payload's digest agrees and the entry is no error, else from `work`.

    cache: key, fingerprint, status, result. A batch that fails is halved until single rows are left; a row that fails
    alone is an error row, and errors are computed anew next time. Returns key, fingerprint, status, result, cached.
    """
    stamped = rows.select(key, payload, F.sha2(payload, 256).alias("fingerprint"))
    held = cache.where("status <> 'error'").select(key, F.col("fingerprint"), F.col("status"), F.col("result"))
    hits = stamped.join(held, [key, "fingerprint"]).select(key, "fingerprint", "status", "result", F.lit(True).alias("cached"))
    misses = stamped.join(held.select(key, "fingerprint"), [key, "fingerprint"], "left_anti")

    def tried(items: list[str]) -> list[tuple[str, str]]:
        try:
            done = work(items)
            if len(done) != len(items):
                raise ValueError("results don't match the batch")
            return [("ok", d) for d in done]
        except Exception as error:
            if len(items) == 1:
                return [("error", str(error))]
            half = len(items) // 2
            return tried(items[:half]) + tried(items[half:])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), batch):
                cut = part.iloc[at : at + batch]
                done = tried(cut[payload].tolist())
                yield pd.DataFrame({key: cut[key], "fingerprint": cut["fingerprint"], "status": [s for s, _ in done], "result": [r for _, r in done], "cached": False})

    kind = rows.schema[key].dataType.simpleString()
    done = misses.select(key, payload, "fingerprint").mapInPandas(run, f"{key} {kind}, fingerprint string, status string, result string, cached boolean")
    return hits.unionByName(done)
