"""Arrow batch helpers of the training-data operators; intermediate tables are those of the core library."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators.work import broadcast_if_small, discard, materialise, release, rows_in, scoped

__all__ = ["broadcast_if_small", "discard", "give_back", "lean", "map_batches", "materialise", "release", "rows_in", "same_or_null", "scoped"]


def give_back() -> None:
    """Return freed memory to the system. A Python worker lives on after its task, and what it holds counts towards its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that gives back what its task has freed."""

    @functools.wraps(run)
    def to_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return to_the_end


def map_batches(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch | list], schema: str, rows: int = 256) -> DataFrame:
    """``mapInArrow`` in slices of at most ``rows`` rows, so that long texts never meet in one Python object list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = kernel(batch.slice(at, rows))
                if isinstance(out, list):
                    yield from out
                elif out is not None:
                    yield out

    return df.mapInArrow(lean(run), schema)


def same_or_null(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns with clashing names stay outside a plan."""
    return df.select(*[F.col(f"`{c}`") for c in columns])
