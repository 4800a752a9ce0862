"""Order-dependent folds over sorted groups, streamed.

A group (a page) is sorted within its partition and fed row by row to a small
state machine; only the state is held, never the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_sorted(df: DataFrame, keys: list[str], order: list[str | Column], inputs: list[str], start: Callable[[], object], step: Callable[[object, tuple], tuple[object, int]], output: str) -> DataFrame:
    """Number the rows of every group by a sequential rule: all columns plus ``output`` (int).

    Rows of a group (equal ``keys``, nulls equal) come in ``order``.
    ``step(state, values of inputs)`` returns the next state and the row's
    number. One shuffle by ``keys``; constant memory a task.
    """
    columns = df.columns
    at_keys, at_inputs = [columns.index(k) for k in keys], [columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = object(), None
        for batch in batches:
            groups = list(zip(*(batch.column(i).to_pylist() for i in at_keys), strict=True)) if at_keys else [()] * batch.num_rows
            values = zip(*(batch.column(i).to_pylist() for i in at_inputs), strict=True)
            numbers = []
            for group, value in zip(groups, values, strict=True):
                if group != key:
                    key, state = group, start()
                state, number = step(state, value)
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int32())], [*columns, output])

    schema = df.withColumn(output, F.lit(0)).schema
    schema[output].nullable = True
    sorted_rows = (df.repartition(*keys) if keys else df.repartition(1)).sortWithinPartitions(*keys, *order)
    return sorted_rows.mapInArrow(run, schema)


def row_groups(df: DataFrame, keys: list[str], y: str, order: list[str | Column], tolerance: float | str, output: str = "row_index") -> DataFrame:
    """Group sorted positions into rows: a value joins the open row within ``tolerance`` of the row's running mean.

    Input comes by ``y``, then ``order``. As positions ascend, an older row can
    never match once a newer one is open, so one (count, sum) is state enough.
    ``tolerance`` is a number or a column of the same page's tolerance. Null
    positions are not allowed.
    """
    column = tolerance if isinstance(tolerance, str) else None

    def step(state, values):
        limit = values[1] if column else tolerance
        number, n, total = state
        if n and abs(values[0] - total / n) <= limit:
            state = (number, n + 1, total + values[0])
        else:
            state = (number + 1, 1, values[0])
        return state, state[0]

    return fold_sorted(df, keys, [y, *order], [y, column] if column else [y], lambda: (-1, 0, 0.0), step, output)


def merge_bands(df: DataFrame, keys: list[str], order: list[str | Column], max_gap: str, min_overlap: float = 0.15, output: str = "band_index") -> DataFrame:
    """Number text bands: a band joins the last group if it starts within ``max_gap`` of the group's box and shares enough width.

    Columns x1, y1, x2, y2 and the gap column are read; bands come by y1, then
    ``order``. The group's box grows as bands join, so this is a true fold.
    """

    def step(state, values):
        x1, y1, x2, y2, gap = values
        if state:
            number, a1, b1, a2, b2 = state
            shared = max(0, min(a2, x2) - max(a1, x1)) / max(1, min(a2 - a1, x2 - x1))
            if y1 - b2 <= gap and shared >= min_overlap:
                state = (number, min(a1, x1), min(b1, y1), max(a2, x2), max(b2, y2))
                return state, number
            return (number + 1, x1, y1, x2, y2), number + 1
        return (0, x1, y1, x2, y2), 0

    return fold_sorted(df, keys, ["y1", *order], ["x1", "y1", "x2", "y2", max_gap], lambda: None, step, output)


def merge_overlapping(df: DataFrame, keys: list[str], order: list[str | Column], min_vertical: float = 0.15, min_horizontal: float = 0.05, output: str = "band_index") -> DataFrame:
    """Number bands by the first earlier group whose merged box overlaps them enough; groups never merge with each other.

    Bands come by y1, then ``order``. Groups that end above a band cannot match
    it or any later one, as bands come by their upper edge, but keep their number.
    """

    def step(state, values):
        x1, y1, x2, y2 = values
        number, live = state
        live = [g for g in live if g[4] > y1]
        for g in live:
            k, a1, b1, a2, b2 = g
            tall = min(b2, y2) - max(b1, y1)
            wide = max(0, min(a2, x2) - max(a1, x1)) / max(1, min(a2 - a1, x2 - x1))
            if tall > 0 and tall / max(1, min(b2 - b1, y2 - y1)) >= min_vertical and wide >= min_horizontal:
                g[1:] = [min(a1, x1), min(b1, y1), max(a2, x2), max(b2, y2)]
                return (number, live), k
        live.append([number + 1, x1, y1, x2, y2])
        return (number + 1, live), number + 1

    return fold_sorted(df, keys, ["y1", *order], ["x1", "y1", "x2", "y2"], lambda: (-1, []), step, output)
