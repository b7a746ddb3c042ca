"""Tasks give back the memory they have freed."""

import ctypes
import re

import pyarrow as pa
import pytest

import corpus_pipeline
from tillroll.llm import stages
from tillroll.llm.stages import lean


def anonymous_mb():
    with open("/proc/self/smaps_rollup", encoding="ascii") as file:
        return int(re.search(r"\nAnonymous:\s+(\d+)", file.read())[1]) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="another C library")
def test_a_task_gives_freed_memory_back():
    pins = []

    def task(batches):
        pieces = [bytes([1]) * 64_000 for _ in range(4_000)]
        pins.append(bytes([1]) * 64_000)  # lies behind them, so their place is not given back by itself
        pieces.clear()
        yield from batches

    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["a"])
    before = anonymous_mb()
    assert list(lean(task)(iter([batch]))) == [batch]
    assert anonymous_mb() - before < 60


def test_every_python_step_of_a_stage_is_lean(spark, docs, monkeypatch):
    calls = []
    real = type(spark.range(1)).mapInArrow
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, f, *a, **k: calls.append(f.__qualname__) or real(self, f, *a, **k))
    some = docs((1, "a plain sentence about rivers"), (2, "a plain sentence about hills"))
    corpus_pipeline.drop_copies(spark, some, "")
    corpus_pipeline.drop_near_copies(spark, some, "")
    corpus_pipeline.pack(spark, some, "")
    assert calls and set(calls) == {f"{stages.lean.__qualname__}.<locals>.run"}
