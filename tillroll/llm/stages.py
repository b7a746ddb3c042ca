"""Tables that an operator writes between its steps, in the folder all executors share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillroll.functions.sharing import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table: later steps read it, and a lost executor costs no
    earlier step."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(task: Task) -> Task:
    """The function of a task, which at its end gives back what memory it has freed. Workers are
    used again, by tasks of other steps too, so what their allocators keep would add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return run
