"""Memory of Python workers, which live on from task to task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of a batch of rows that goes to a Python worker: Spark's own bound is 64 MB, held several times over on both sides.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4m")}

Run = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Run) -> Run:
    """``run``, after which the worker gives what it freed back to the system, so that the next task's worker is small."""

    @wraps(run)
    def trimmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return trimmed


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers, unless the session has a bound of its own."""
    for key, (usual, bound) in BATCH.items():
        if spark.conf.get(key) == usual:
            spark.conf.set(key, bound)
