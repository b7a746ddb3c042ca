"""Frames that several branches of one plan read, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_STAGE_WRITES = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}
_shared: ContextVar[list[DataFrame]] = ContextVar("shared", default=[])  # noqa: B039


def share(df: DataFrame) -> DataFrame:
    """Mark a frame that its consumer reads more than once. Lazy: nothing runs here.

    Blocks go to memory and spill to disk; a block lost with its executor is
    recomputed from lineage. Used only for frames already reduced by a ``groupBy``
    or a filter, never for the raw order lines.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    _shared.get().append(kept)
    return kept


def release_shared() -> None:
    """Drop the shared frames of this scope. Call it when the results have been written."""
    frames = _shared.get()
    while frames:
        frames.pop().unpersist()


@contextmanager
def shared_scope() -> Iterator[None]:
    """Frames shared inside are dropped at the end; those of other callers stay."""
    token = _shared.set([])
    try:
        yield
    finally:
        release_shared()
        _shared.reset(token)


@contextmanager
def stage_writes(spark: SparkSession) -> Iterator[None]:
    """Writes inside drop their shuffle files when they end, not when the driver happens to
    collect its garbage, and fill a few partitions of a table without sorting the rows."""
    before = {key: spark.conf.get(key) for key in _STAGE_WRITES}
    try:
        for key, value in _STAGE_WRITES.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors see (``spark.checkpoint.dir``).

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tillroll-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder; sets one only where none is set."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoints"))
    return df.checkpoint()
