"""Overlap suppression within pages (GRD5-7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.boxes import iou
from inkmill.operators.work import discard, materialise, scoped


def complex_order(priority: str = "priority", score: str = "score") -> list[Column]:
    """Protected groups first, then large boxes, then priority, then score (the shape matcher's order)."""
    return [(F.col(priority) >= 50).desc(), (F.col("w") * F.col("h")).desc(), F.desc(priority), F.desc(score)]


def priority_order(priority: str = "priority", score: str = "score") -> list[Column]:
    return [F.desc(priority), F.desc(score)]


def cascade_order(area: str = "area", score: str = "score", *, score_only: bool = False) -> list[Column]:
    """GRD6, GRD7: larger templates first, or the score alone."""
    return [F.desc(score)] if score_only else [F.desc(area), F.desc(score)]


def suppress(boxes: DataFrame, page: list[str], order: list[Column], tie: list[str], threshold: float) -> DataFrame:
    """Greedy non-maximum suppression: in ``order`` (then ``tie``), keep a box unless a kept one overlaps it by ``threshold`` or more.

    Columns x, y, w, h. One shuffle by page, one pass: a page's kept boxes are
    all that is held, in arrays that a new box is compared with at once.
    """
    columns = boxes.columns
    at = [columns.index(c) for c in ("x", "y", "w", "h")]
    at_page = [columns.index(c) for c in page]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, n = object(), np.empty((64, 4)), 0
        for batch in batches:
            pages = list(zip(*(batch.column(i).to_pylist() for i in at_page), strict=True))
            box = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in at]) if batch.num_rows else np.empty((0, 4))
            stays = np.ones(batch.num_rows, bool)
            for k in range(batch.num_rows):
                if pages[k] != now:
                    now, n = pages[k], 0
                x, y, w, h = box[k]
                a, b, c, d = kept[:n].T
                inter = np.maximum(0, np.minimum(a + c, x + w) - np.maximum(a, x)) * np.maximum(0, np.minimum(b + d, y + h) - np.maximum(b, y))
                union = c * d + w * h - inter
                share = np.divide(inter, union, out=np.zeros(n), where=union != 0)
                stays[k] = not (share >= threshold).any()
                if stays[k]:
                    if n == len(kept):
                        kept = np.concatenate([kept, np.empty_like(kept)])
                    kept[n], n = box[k], n + 1
            yield batch.filter(pa.array(stays))

    return boxes.repartition(*page).sortWithinPartitions(*page, *order, *tie).mapInArrow(run, boxes.schema)


@scoped
def suppress_by_rounds(boxes: DataFrame, page: list[str], order: list[Column], tie: list[str], threshold: float) -> DataFrame:
    """The same result by joins alone: each round keeps the boxes without a better undecided overlap and drops what these overlap."""
    rank = F.row_number().over(Window.partitionBy(*page).orderBy(*order, *tie))
    open_, kept = materialise(boxes.withColumn("_rank", rank), "boxes"), None
    pairs = None
    while open_.limit(1).count():  # every round decides each page's best open box at least
        a, b = (open_.select(*page, *[F.col(c).alias(f"{p}{c}") for c in ("x", "y", "w", "h", "_rank")]) for p in ("a", "b"))
        pairs = a.join(b, page).where((F.col("a_rank") < F.col("b_rank")) & (iou("a", "b") >= threshold))
        pairs = materialise(pairs.select(*page, F.col("a_rank").alias("better"), F.col("b_rank").alias("_rank")), "pairs")
        stay = materialise(open_.join(pairs, [*page, "_rank"], "left_anti"), "boxes")
        gone = pairs.join(stay.select(*page, F.col("_rank").alias("better")), [*page, "better"], "left_semi").select(*page, "_rank").distinct()
        rest = materialise(open_.join(stay, [*page, "_rank"], "left_anti").join(gone, [*page, "_rank"], "left_anti"), "boxes")
        discard(open_, pairs)
        kept, open_ = stay if kept is None else kept.unionByName(stay), rest
    return (open_ if kept is None else kept).drop("_rank")
