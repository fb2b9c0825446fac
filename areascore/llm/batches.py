"""Helpers for tasks that read texts in record batches."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import SparkSession

#: Bytes of text a task works on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 21


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each piece holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def worker_store(owner: str) -> dict:
    """What tasks of ``owner`` leave in a worker process for those that follow there; what other operators left is dropped.

    Workers stay when a stage ends, and the tasks of the next operator get the same ones, with all the memory they hold.
    """
    module = sys.modules.setdefault("worker_store", ModuleType("worker_store"))
    if getattr(module, "owner", None) != owner:
        module.owner, module.kept = owner, {}
    return module.kept


class Shared:
    """A broadcast of objects of this package, which executors need not have: classes travel with the value."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self._packed, self._value = spark.sparkContext.broadcast(cloudpickle.dumps(value)), value

    def __getstate__(self) -> dict:
        return {"_packed": self._packed, "_value": None}

    @property
    def value(self) -> object:
        if self._value is None:  # once per task
            self._value = pickle.loads(self._packed.value)
        return self._value
