"""Glyph templates and their matches on pages (SRC26, IMG13-15, IMG17, AGG5-8, AGG21, FLT2-5, FLT14, GRD5-6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.functions import kernels
from inkmill.functions.boxes import template_fits
from inkmill.functions.text import GLYPH_RANGES, codepoint_key, in_ranges
from inkmill.operators.suppress import cascade_order, complex_order, priority_order, suppress

#: Templates travel with the plan; a larger set needs pages and templates in blocks.
MAX_TEMPLATE_BYTES = 64 << 20
_DETECTIONS = "page string, ord int, label string, pt double, x int, y int, w int, h int, area int, score double"


def otsu_of_histogram(histogram: DataFrame) -> DataFrame:
    """IMG2: Otsu's level of a histogram (v, c) of at most 256 levels: threshold."""
    from pyspark.sql import Window

    upto, whole = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy()
    run = histogram.withColumns({"w0": F.sum("c").over(upto), "s0": F.sum(F.col("v") * F.col("c")).over(upto)})
    run = run.withColumns({"w": F.sum("c").over(whole), "s": F.sum(F.col("v") * F.col("c")).over(whole)})
    w0, w1 = F.col("w0").cast("double"), (F.col("w") - F.col("w0")).cast("double")
    between = F.when(w1 > 0, w0 * w1 * F.pow(F.col("s0") / w0 - (F.col("s") - F.col("s0")) / w1, F.lit(2))).otherwise(0.0)
    return run.agg(F.max_by("v", between).alias("threshold"))


def glyph_shapes(glyphs: DataFrame, ranges=GLYPH_RANGES, canvas: int = 48) -> DataFrame:
    """SRC26, FLT2, IMG10: normalised shapes of glyph bitmaps in range: id (code point), key, glyph_name, vec; blanks are dropped.

    ``glyphs``: cp, glyph_name, width, height, data (gray bytes).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                shape = kernels.normal_shape(np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"]), canvas)
                if shape is not None:
                    out.append({"id": r["cp"], "glyph_name": r["glyph_name"], "vec": ((255 - shape.astype(np.float64)) / 255).ravel()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("id", pa.int64()), ("glyph_name", pa.string()), ("vec", pa.list_(pa.float64()))]))

    wanted = glyphs.where((F.col("cp") >= 0x20) & in_ranges("cp", ranges)).select("cp", "glyph_name", "width", "height", "data")
    return wanted.mapInArrow(run, "id long, glyph_name string, vec array<double>").withColumn("key", codepoint_key("id"))


def templates(glyphs: DataFrame, labels: DataFrame, sizes_pt: list[float], dpi: int = 300, base_pt: float = 96.0) -> DataFrame:
    """IMG15, FLT3-5, AGG21: matchable templates of every label and size: label, pt, width, height, data.

    ``glyphs``: cp, width, height, data, drawn at ``base_pt`` and ``dpi``.
    ``labels``: label, cp. A label's equal templates of a size are one; of
    equal ones the first code point's stays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                image = np.frombuffer(r["data"], np.uint8).reshape(r["height"], r["width"])
                for pt in sizes_pt:
                    h, w = (max(1, int(s * pt / base_pt)) for s in image.shape)
                    t = np.where(kernels.resample(image, h, w) > 200, 255, 0).astype(np.uint8)
                    area, ink, spread, rows = kernels.template_metrics(t)
                    out.append({"label": r["label"], "cp": r["cp"], "pt": pt, "width": w, "height": h, "data": t.tobytes(), "area": area, "ink": ink, "spread": spread, "ink_rows": rows})
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("label", pa.string()), ("cp", pa.int32()), ("pt", pa.float64()), ("width", pa.int32()), ("height", pa.int32()), ("data", pa.binary()), ("area", pa.int32()), ("ink", pa.float64()), ("spread", pa.float64()), ("ink_rows", pa.int32())])
    drawn = glyphs.join(labels, "cp").select("label", "cp", "width", "height", "data")
    made = drawn.mapInArrow(run, "label string, cp int, pt double, width int, height int, data binary, area int, ink double, spread double, ink_rows int")
    fit = made.where(template_fits("area", "ink", "spread", "ink_rows", "width", "height"))
    once = fit.groupBy("label", "pt", "width", "height", F.sha2("data", 256).alias("h")).agg(F.min("cp").alias("cp"), F.min_by("data", "cp").alias("data"))
    return once.drop("h")


def detections(pages: DataFrame, made: DataFrame, thresholds: dict[str, float], default: float = 0.65, *, only_peaks: bool = True, gradients: bool = False, level: int = 200) -> DataFrame:
    """IMG13, IMG14, FLT14: every template's placements on every page: page, ord, label, pt, x, y, w, h, area, score.

    ``pages``: page, width, height, channels, data. Pages are split at
    ``level`` first; pages whose bytes do not fit their size are skipped.
    """
    rows = made.orderBy("label", "pt", "cp").collect() if made.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0] <= MAX_TEMPLATE_BYTES else None
    if rows is None:
        raise ValueError("the templates are too large to travel with the plan")
    ready = [(r.label, r.pt, bytes(r.data), r.height, r.width) for r in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kit = [(label, pt, np.frombuffer(data, np.uint8).reshape(h, w)) for label, pt, data, h, w in ready]
        kit = [(label, pt, kernels.gradient(t) if gradients else t) for label, pt, t in kit]
        for batch in batches:
            for p in batch.to_pylist():
                if p["data"] is None or len(p["data"]) != p["width"] * p["height"] * p["channels"]:
                    continue
                image = kernels.gray(np.frombuffer(p["data"], np.uint8).reshape(p["height"], p["width"], -1))
                image = np.where(image > level, 255, 0).astype(np.uint8)
                image = kernels.gradient(image) if gradients else image
                found = [(label, pt, *hit[:4], t.size, hit[4]) for label, pt, t in kit for hit in kernels.find_template(image, t, thresholds.get(label, default), only_peaks=only_peaks)]
                names = ("label", "pt", "x", "y", "w", "h", "area", "score")
                yield pa.RecordBatch.from_pylist([{"page": p["page"], "ord": k} | dict(zip(names, f, strict=True)) for k, f in enumerate(found)], schema)

    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in _DETECTIONS.split(", "))])
    return pages.select("page", "width", "height", "channels", "data").mapInArrow(run, _DETECTIONS)


def match_groups(pages: DataFrame, made: DataFrame, limits: dict[str, tuple[float, int]], threshold: float = 0.75, iou: float = 0.3, *, complex_first: bool = True) -> DataFrame:
    """IMG14, GRD5: suppressed matches of shape groups. ``limits``: label -> (threshold, priority); the default priority is 10."""
    found = detections(pages, made, {k: t for k, (t, _) in limits.items()}, threshold)
    priority = F.coalesce(F.create_map(*[x for k, (_, p) in limits.items() for x in (F.lit(k), F.lit(p))])[F.col("label")], F.lit(10)) if limits else F.lit(10)
    ranked = found.withColumn("priority", priority)
    return suppress(ranked, ["page"], complex_order() if complex_first else priority_order(), ["ord"], iou)


def match_cascade(pages: DataFrame, made: DataFrame, threshold: float = 0.65, iou: float = 0.3, *, score_only: bool = False, gradients: bool = False) -> DataFrame:
    """GRD6, IMG17: all placements, larger templates first, or the score alone."""
    found = detections(pages, made, {}, threshold, only_peaks=False, gradients=gradients)
    return suppress(found, ["page"], cascade_order(score_only=score_only), ["ord"], iou)


def page_counts(found: DataFrame) -> DataFrame:
    """AGG6, AGG7: detections by page and label."""
    return found.groupBy("page", "label").agg(F.count("*").alias("n"))


def frequency_table(counts: DataFrame, known: DataFrame, pages: int) -> DataFrame:
    """AGG8: every known label with its count, share of all counts, and count a page, ranked: label, n, per_page, pct, rank. ``known``: label, cp."""
    from inkmill.operators.stats import ranked

    summed = counts.groupBy("label").agg(F.sum("n").alias("n"))
    total = summed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    rows = known.join(summed, "label", "left").withColumn("n", F.coalesce("n", F.lit(0))).crossJoin(F.broadcast(total))
    pct = F.when(F.col("total") > 0, F.round(F.lit(100.0) * F.col("n") / F.col("total"), 3)).otherwise(0.0)
    return ranked(rows.select("label", "cp", "n", F.round(F.col("n") / max(1, pages), 3).alias("per_page"), pct.alias("pct")), [F.desc("n"), F.asc("cp")])
