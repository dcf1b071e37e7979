"""Helpers of the operators: written intermediate tables, skew-safe joins, scratch columns.

Every intermediate table is written as Parquet below ``spark.checkpoint.dir``, which a cluster
shares between driver and executors, so that a lost executor costs no recomputation.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Largest table that :func:`sent_if_small` marks for broadcast.
BROADCAST_BYTES = 32 << 20
#: Texts that are read at a time, and that go to a Python worker at a time.
READ_TEXTS, BATCH_TEXTS = 1024, 1000

_written: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``. Only a local session (one machine, as in tests) may leave it unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{os.path.join(tempfile.gettempdir(), 'loomspark-checkpoints')}"
    return found.rstrip("/")


def materialize(df: DataFrame, label: str, merged: bool = False) -> DataFrame:
    """Writes df to a table of its own in the shared folder and returns a reader of it.

    merged: df is narrow and may leave many small files; its rows are rebalanced into files of the session's advisory size.

    The reader is a plain scan: lineage ends there, and a join above it can have its skewed
    partitions split at run time.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    (df.hint("rebalance") if merged else df).write.parquet(path)
    _written[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def sent_if_small(df: DataFrame, row_bytes: int | Column) -> DataFrame:
    """A written table, marked for broadcast if its rows take at most BROADCAST_BYTES as counted (or summed, where rows
    differ in size); a larger one is joined by shuffles."""
    size = df.agg(F.sum(row_bytes)).first()[0] or 0 if isinstance(row_bytes, Column) else df.count() * row_bytes
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A batch function after which the worker gives freed memory back, as idle workers of earlier stages stay beside later ones."""

    @wraps(run)
    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        _give_back()

    return whole


def read_gently(spark: SparkSession) -> None:
    """Lowers two settings of the session, as texts can be long: rows that a reader takes apart at a time, and rows of a batch to Python."""
    for name, most in (("spark.sql.parquet.columnarReaderBatchSize", READ_TEXTS), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_TEXTS)):
        if not 0 < int(spark.conf.get(name)) <= most:
            spark.conf.set(name, str(most))


def arrow_map(df: DataFrame, run: Callable[[Iterator], Iterator], schema: StructType) -> DataFrame:
    """mapInArrow for texts: batches are small (:func:`read_gently`), and workers are tidied after their tasks."""
    read_gently(df.sparkSession)
    return df.mapInArrow(tidied(run), schema)


def _give_back() -> None:
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def drop(df: DataFrame) -> None:
    """Deletes a table that :func:`materialize` wrote and that nothing reads any more."""
    _delete(df.sparkSession, getattr(df, "_written_to", None))


def mark() -> set[str]:
    """Tables that are there now, for :func:`release`."""
    return set(_written)


def release(before: set[str], *kept: DataFrame) -> None:
    """Deletes the tables written since the mark but those that a result still reads."""
    held = before | {df._written_to for df in kept}
    for path in [p for p in _written if p not in held]:
        _delete(_written[path], path)


def _delete(spark: SparkSession, path: str | None) -> None:
    if path and _written.pop(path, None) is not None:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _at_exit() -> None:
    for path, spark in list(_written.items()):
        if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
            _written.pop(path)
            continue
        _delete(spark, path)


def fresh(df: DataFrame, name: str) -> str:
    """The name, or a longer one, that df has no column of."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
