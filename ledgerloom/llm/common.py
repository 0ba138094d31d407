"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: An Arrow slice handed to one step of a task holds about so many bytes of text, or a single row.
SLICE_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A column-pruned scan of one given table."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands rows to workers about SLICE_BYTES at a time, unless the session says how many bytes.

    By itself it fills a batch up to 10,000 rows or 64 MB, which the executor and the worker hold several times over;
    what is freed of blocks so large stays with the process.  Rows and their order are the same.
    """
    if _BATCH not in spark.conf.getAll:
        spark.conf.set(_BATCH, str(SLICE_BYTES))


def pieces(batches: Iterator[pa.RecordBatch], column: int = 1, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `size` bytes of text or binary in `column`, so that a task's memory is bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def hand_back() -> None:
    """Give memory that this worker has freed back to the machine."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps its own counsel
        pass


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run`, a pass over the batches of a task, after which the worker hands back the memory that it no longer needs.

    Workers are used again, and what one of them keeps adds to what an executor holds.
    """

    @functools.wraps(run)
    def passed(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        hand_back()

    return passed
