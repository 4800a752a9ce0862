"""Glyphs and pages drawn from the driver's tables by a rule that SQL can repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions import kernels
from inkmill.functions.text import GLYPH_RANGES
from inkmill.operators import matching
from inkmill.operators.work import materialise, scoped, scratch_folder
from inkmill.plans.registry import query, table
from inkmill.sources import files, sinks


def _ink(a: str, b: str, r: str, c: str, side: int) -> str:
    """The rule: ink of a drawing numbered a, b at row r and column c; the first and last rows have ink, margins vary by a and b."""
    rule = f"(({r} * ({a} % 7 + 1) + {c} * ({b} % 5 + 1) + {r} * {c}) % 11 < 4)"
    ends = f"({r} = 0 and {c} = {a} % 4 + {a} % 3) or ({r} = {side - 1} and {c} = {a} % 4 + {b} % 3)"
    return f"({c} >= {a} % 4 and {c} < {side} - {b} % 4 and ({rule} or {ends}))"


def _drawn(a: str, b: str, side: int) -> Column:
    """The drawing's gray bytes."""
    cells = f"transform(sequence(0, {side * side - 1}), i -> if({_ink(a, b, f'(i div {side})', f'(i % {side})', side)}, '00', 'FF'))"
    return F.expr(f"unhex(array_join({cells}, ''))")


def _cells(relation: str, keys: str, a: str, b: str, side: int) -> str:
    """The same in SQL: keys, i, r, c, ink."""
    return f"select {keys}, i, i // {side} as r, i % {side} as c, {_ink(a, b, f'(i // {side})', f'(i % {side})', side)} as ink from {relation}, (select unnest(range({side * side})) as i)"


def _glyphs(spark, sf_dir) -> DataFrame:
    """One glyph of 12 x 12 pixels for every part."""
    return table(spark, sf_dir, "part").select((F.col("p_partkey") + 32).cast("int").alias("cp"), F.col("p_name").alias("glyph_name"), "p_brand", F.lit(12).alias("width"), F.lit(12).alias("height"), _drawn("p_size", "p_partkey", 12).alias("data"))


_GLYPH_CELLS = _cells("part", "cast(p_partkey + 32 as int) as cp, p_name, p_brand", "p_size", "p_partkey", 12)
_IN_RANGE = " or ".join(f"cp between {lo} and {hi}" for lo, hi in GLYPH_RANGES)


@query(f"""
    with cells as ({_GLYPH_CELLS}), spans as (select cp, p_name, min(c) as x1, max(c) as x2, list(r * 12 + c) as places from cells where ink and ({_IN_RANGE}) group by cp, p_name),
    placed as (select cp, p_name, list_transform(places, lambda p: p - x1 + (12 - (x2 - x1 + 1)) // 2) as places from spans)
    select cast(cp as bigint) as id, p_name as glyph_name, printf('U+%04X', cp) as key, array_to_string(list_transform(range(144), lambda i: case when list_contains(places, i) then '1' else '0' end), '') as shape from placed""")
def q82_glyph_shapes(spark, sf_dir):
    """SRC23, SRC26, FLT2, IMG10: the glyphs in range, cropped to their ink and centred."""
    shapes = matching.glyph_shapes(_glyphs(spark, sf_dir), canvas=12)
    return shapes.select("id", "glyph_name", "key", F.array_join(F.transform("vec", lambda v: v.cast("int").cast("string")), "").alias("shape"))


@query(f"""
    with cells as ({_GLYPH_CELLS}), rows as (select cp, p_brand, r, count(*) filter (ink) as n from cells group by all),
    metrics as (select cp, p_brand, sum(n) / 144 as share, stddev_pop(n / 12) as spread, count(*) filter (n > 0) as inked from rows group by all),
    bytes as (select cp, sha256(string_agg(case when ink then '00' else 'FF' end, '' order by i)) as digest from cells group by cp)
    select p_brand as label, min(cp) as cp, 96.0::double as pt, 12 as width, 12 as height, digest from metrics join bytes using (cp) where share between 0.04 and 0.55 and spread >= 0.08 and inked >= 4 group by p_brand, digest""")
def q83_templates(spark, sf_dir):
    """IMG15, FLT3, FLT4, AGG21: every label's matchable templates, equal ones once."""
    glyphs = _glyphs(spark, sf_dir)
    made = matching.templates(glyphs.drop("p_brand"), glyphs.select(F.col("p_brand").alias("label"), "cp"), [96.0])
    return made.select("label", "cp", "pt", "width", "height", F.sha2(F.hex("data"), 256).alias("digest"))


#: Thresholds of two labels, and of all others.
_THRESHOLDS, _THRESHOLD = {"NATION_1": 0.5271, "NATION_2": 0.2213}, 0.3137
_LEAST = "case label " + " ".join(f"when '{k}' then {v}" for k, v in _THRESHOLDS.items()) + f" else {_THRESHOLD} end"


@query(f"""
    with marks as ({_cells("nation", "n_name as label", "n_nationkey", "n_regionkey", 9)}), pages as ({_cells("supplier", "s_suppkey as page", "s_suppkey", "s_nationkey", 16)}),
    mean as (select label, r, c, case when ink then 0 else 255 end as v, avg(case when ink then 0 else 255 end) over (partition by label) as m from marks),
    fit as (select label from (select label, r, count(*) filter (ink) as n from marks group by all) group by label having sum(n) / 81 between 0.04 and 0.55 and stddev_pop(n / 9) >= 0.08 and count(*) filter (n > 0) >= 4),
    spots as (
        select page, label, p.c - t.c as x, p.r - t.r as y, sum((t.v - t.m) * (case when p.ink then 0 else 255 end)) as top, sum((t.v - t.m) ** 2) as own, sum(case when p.ink then 0 else 255 end) as s, sum((case when p.ink then 0 else 255 end) ** 2) as ss
        from pages p, mean t where label in (select label from fit) and p.c - t.c between 0 and 7 and p.r - t.r between 0 and 7 group by all),
    scores as (select *, case when sqrt(greatest(0, ss - s * s / 81) * own) > 1e-6 then top / sqrt((ss - s * s / 81) * own) else 0 end as score from spots)
    select page, cast(row_number() over (partition by page order by label, y, x) - 1 as int) as ord, label, cast(x as int) as x, cast(y as int) as y, 9 as w, 9 as h, round(score, 6) as score from scores where score >= {_LEAST}""")
def q84_placements(spark, sf_dir):
    """IMG13, IMG14, FLT14: every template's placements on every page at or over its label's threshold."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("cp"), F.col("n_name").alias("label"), F.lit(9).alias("width"), F.lit(9).alias("height"), _drawn("n_nationkey", "n_regionkey", 9).alias("data"))
    made = matching.templates(nation.drop("label"), nation.select("label", "cp"), [96.0])
    pages = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("page"), F.lit(16).alias("width"), F.lit(16).alias("height"), F.lit(1).alias("channels"), _drawn("s_suppkey", "s_nationkey", 16).alias("data"))
    found = matching.detections(pages, made, _THRESHOLDS, _THRESHOLD, only_peaks=False)
    return found.select(F.col("page").cast("long").alias("page"), "ord", "label", "x", "y", "w", "h", F.round("score", 6).alias("score"))


def _rasterise(data: bytes, page: int, dpi: int) -> np.ndarray:
    """A page of 30 x 40 pixels with one block of ink; where it lies depends on the file and the page."""
    image = np.full((30, 40), 255, np.uint8)
    at = (int(data) * 7 + page * 11) % 30
    image[5 : 5 + 3 * page, at : at + 8] = 0
    return image


@query("""
    with pages as (select s_suppkey as k, unnest(range(1, length(cast(s_suppkey as varchar)) + 2)) as p from supplier), spots as (select *, (k * 7 + p * 11) % 30 as x from pages)
    select 'b' || k as book_id, cast(p as int) as page_number, 40 as width, 30 as height, 1 as channels, case when k % 5 = 0 then 'rtl' when k % 5 = 1 and p = 2 then 'ltr' when x + 3.5 > 20 then 'rtl' else 'ltr' end as direction, 24 * p / 1200 as ink_ratio,
           sha256(repeat('FF', 200) || repeat(repeat('FF', x) || repeat('00', 8) || repeat('FF', 32 - x), 3 * p) || repeat('FF', 40 * (25 - 3 * p))) as digest from spots""")
@scoped
def q85_rendered_pages(spark, sf_dir):
    """SRC2-SRC6, SNK2, PRJ1, PRJ3, PRJ5, PRJ6: pages are drawn by a given rasteriser, written as PNG files and read again beside their manifest."""
    supplier = table(spark, sf_dir, "supplier")
    book = F.concat(F.lit("b"), "s_suppkey")
    pdfs = supplier.select(F.concat(book, F.lit(".pdf")).alias("path"), book.alias("book_id"), F.col("s_suppkey").cast("string").cast("binary").alias("content"))
    chunks = files.page_counts(pdfs, lambda data: len(data) + 1).select("book_id", F.lit(1).alias("chunk_first"), F.col("pages").alias("chunk_last"))
    whole = supplier.where("s_suppkey % 5 = 0").select(book.alias("book"), F.lit("default").alias("key"), F.lit("rtl").alias("direction"))
    single = supplier.where("s_suppkey % 5 = 1").select(book.alias("book"), F.lit("page_0002").alias("key"), F.lit("ltr").alias("direction"))
    root = scratch_folder(spark, "drawn")
    drawn = materialise(files.render_pages(pdfs, chunks, _rasterise, root, whole.unionByName(single), direction="auto"), "rendered")
    sinks.write_pages(drawn)
    images = files.page_images(spark, [root]).select("book_id", "page_number", "width", "height", "channels", F.sha2(F.hex("data"), 256).alias("digest"))
    return images.join(drawn.select("book_id", "page_number", "direction", "ink_ratio"), ["book_id", "page_number"])


_PAGE_CELLS = _cells("supplier", "s_suppkey as page", "s_suppkey", "s_nationkey", 16)


def _drawn_pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("page"), _drawn("s_suppkey", "s_nationkey", 16).alias("data"))


@query(f"""
    with recursive cells as (select page, i, r, c from ({_PAGE_CELLS}) where ink),
    reach as (select page, i as start, i, r, c from cells union select a.page, a.start, b.i, b.r, b.c from reach a join cells b on a.page = b.page and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1),
    labels as (select page, i, r, c, min(start) as label from reach group by all)
    select page, cast(min(c) as int) as x, cast(min(r) as int) as y, cast(max(c) - min(c) + 1 as int) as w, cast(max(r) - min(r) + 1 as int) as h, cast(count(*) as int) as area, round(sum(r) / count(*), 6) as mean_y from labels group by page, label""")
def q86_components(spark, sf_dir):
    """IMG7: the 8-connected components of drawn pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = kernels.components(255 - np.frombuffer(data, np.uint8).reshape(16, 16))
                columns = [pa.array([page] * len(found), pa.int64()), *[pa.array(found[:, k].astype(np.int32)) for k in range(5)], pa.array(found[:, 5])]
                yield pa.RecordBatch.from_arrays(columns, ["page", "x", "y", "w", "h", "area", "mean_y"])

    found = _drawn_pages(spark, sf_dir).mapInArrow(run, "page long, x int, y int, w int, h int, area int, mean_y double")
    return found.withColumn("mean_y", F.round("mean_y", 6))


@query(f"""
    with cells as ({_PAGE_CELLS}), kept as (select *, ink and (r + page) % 3 > 0 as shown from cells), spans as (select page, min(r) as y1, max(r) as y2, min(c) as x1, max(c) as x2 from kept where shown group by page)
    select page, sha256(string_agg(case when shown then '00' else 'FF' end, '' order by i)) as masked, cast(max(y2 - y1 + 1) as int) as crop_height, cast(max(x2 - x1 + 1) as int) as crop_width,
           sha256(string_agg(case when shown then '00' else 'FF' end, '' order by i) filter (r between y1 and y2 and c between x1 and x2)) as crop,
           case when avg(c) filter (shown) > 8 then 'rtl' else 'ltr' end as direction, count(*) filter (shown) / 256 as ink
    from kept join spans using (page) group by page""")
def q87_masked_pages(spark, sf_dir):
    """IMG6, IMG10, PRJ3, PRJ6: pages with rows masked out, cropped to what is left, and their direction and ink."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shown = ((np.arange(16) + page) % 3 > 0)[:, None] & np.ones(16, bool)
                image = kernels.apply_mask(np.frombuffer(data, np.uint8).reshape(16, 16), np.where(shown, 255, 0))
                crop = kernels.crop_to_ink(image)
                out.append({"page": page, "masked": image.tobytes(), "crop": crop.tobytes(), "crop_height": crop.shape[0], "crop_width": crop.shape[1], "direction": kernels.direction(image), "ink": kernels.ink_ratio(image)})
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema([("page", pa.int64()), ("masked", pa.binary()), ("crop", pa.binary()), ("crop_height", pa.int32()), ("crop_width", pa.int32()), ("direction", pa.string()), ("ink", pa.float64())])
    found = _drawn_pages(spark, sf_dir).mapInArrow(run, "page long, masked binary, crop binary, crop_height int, crop_width int, direction string, ink double")
    return found.withColumns({k: F.sha2(F.hex(k), 256) for k in ("masked", "crop")})
