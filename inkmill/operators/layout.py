"""Page layout: bands of ink to notation rows, their texts, and the rest (AGG10-11, JN10-14, JN17-19, IMG8, D5-7)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions import kernels
from inkmill.functions.boxes import centre, is_modifier, is_notation, is_text, overlap, width_share
from inkmill.operators.folds import merge_bands, merge_overlapping
from inkmill.operators.work import materialise, scoped

_BAND = "page string, page_width int, page_height int, direction string, x1 int, y1 int, x2 int, y2 int, n int, long int, long_width int, ink double"
_COUNTS = ("n", "long", "long_width")


def pair_texts(rows: DataFrame, texts: DataFrame, page: list[str], row_id: str, text_id: str, reach: Column, height: Column) -> DataFrame:
    """JN10, JN11, JN17, JN18, WIN4: each text's row, and what becomes of texts without one.

    ``rows`` and ``texts``: page columns, an id, y1, y2. A text belongs to a row
    whose centre is above its own, whose lower edge is within ``reach``, and
    whose next row starts below the text's upper edge; it may belong to several.
    Returns page, text id, row id (null without a row), route: lyrics,
    unpaired (a row is near but the next one cuts in) or non_score.
    """
    order = Window.partitionBy(*page).orderBy("y1", row_id)
    r = rows.select(*[F.col(p).alias(f"_r_{p}") for p in page], row_id, F.col("y1").alias("ry1"), F.col("y2").alias("ry2"), F.lead("y1").over(order).alias("next"))
    same = reduce(lambda a, b: a & b, [F.col(p) == F.col(f"_r_{p}") for p in page])
    near = (centre("y1", "y2") > centre("ry1", "ry2")) & (F.greatest(F.lit(0), F.col("y1") - F.col("ry2")) <= reach)
    joined = texts.join(r, same & near, "left").drop(*[f"_r_{p}" for p in page])
    joined = joined.join(rows.groupBy(*page).agg(F.min("y1").alias("first")), page, "left")
    own = F.col(row_id).isNotNull() & (F.col("y1") < F.coalesce("next", height))
    of_text = Window.partitionBy(*page, text_id)
    marked = joined.withColumn("_own", own).withColumns({"_any": F.max("_own").over(of_text), "_nth": F.row_number().over(of_text.orderBy(row_id))})
    route = F.when(F.col("_own"), "lyrics").when(F.col("y1") < F.coalesce("first", height), "non_score").when(F.col(row_id).isNotNull(), "unpaired").otherwise("non_score")
    kept = marked.where(F.col("_own") | (~F.col("_any") & (F.col("_nth") == 1)))
    return kept.select(*page, text_id, F.when(F.col("_own"), F.col(row_id)).alias(row_id), route.alias("route"))


def page_bands(image: np.ndarray, least: int = 3) -> list[tuple]:
    """AGG11, GRD1: bands of a page: x1, y1, x2, y2, components, long ones, their width, share of ink in the whole box."""
    ink = kernels.binarize(image)
    height, width = ink.shape
    parts = kernels.components(ink)
    parts = parts[(parts[:, 4] >= 3) & (parts[:, 3] > 0)]
    parts = parts[np.argsort(parts[:, 5], kind="stable")]
    tolerance, groups, mean = max(6, int(height * 0.006)), [], 0.0
    for k, y in enumerate(parts[:, 5]):
        if groups and abs(y - mean) <= tolerance:
            groups[-1].append(k)
        else:
            groups.append([k])
        mean = parts[groups[-1], 5].mean()
    wide, low, out = max(12, int(width * 0.01)), max(8, int(height * 0.025)), []
    for g in groups:
        x, y, w, h = parts[g, :4].astype(int).T
        box = x.min(), y.min(), (x + w).max(), (y + h).max()
        if box[3] - box[1] >= least:
            long = (w >= wide) & (h <= low) & (w / h >= 3)
            out.append((*map(int, box), len(g), int(long.sum()), int(w[long].sum()), float((ink[box[1] : box[3], box[0] : box[2]] > 0).mean())))
    return out


def bands(pages: DataFrame, direction: str = "ltr", least: int = 3) -> DataFrame:
    """Bands of page images, one row each; a page without any gives one row without a box. ``pages``: page, width, height, channels, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                image = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], -1)
                side = kernels.direction(image) if direction == "auto" else direction
                out = [{"page": row["page"], "page_width": row["width"], "page_height": row["height"], "direction": side} | dict(zip(("x1", "y1", "x2", "y2", "n", "long", "long_width", "ink"), band, strict=True)) for band in page_bands(image, least) or [(None,) * 8]]
                yield pa.RecordBatch.from_pylist(out, schema)

    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in _BAND.split(", "))])
    return pages.select("page", "width", "height", "channels", "data").mapInArrow(run, _BAND)


def merged(df: DataFrame, keys: list[str]) -> DataFrame:
    """AGG10: one band from each group: outer box, summed counts, ink weighted by area over the outer box."""
    weight = F.sum(F.col("ink") * (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")))
    area = F.greatest(F.lit(1), (F.max("x2") - F.min("x1")) * (F.max("y2") - F.min("y1")))
    return df.groupBy(*keys).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), *[F.sum(c).cast("int").alias(c) for c in _COUNTS], (weight / area).alias("ink"))


def _kinds(df: DataFrame) -> DataFrame:
    notation = is_notation("n", "long", "long_width", F.col("x2") - F.col("x1"))
    return df.withColumn("notation", notation).withColumn("text", is_text("n", F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("notation")))


def _renamed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("page", "page_height", *[F.col(c).alias(f"{prefix}{c}") for c in ("id", "x1", "y1", "x2", "y2", *_COUNTS, "ink", "notation", "text")])


@scoped
def layout(found: DataFrame) -> DataFrame:
    """JN19: the nested layout of every page (D7) from its bands.

    All joins are by page. Returns page, page_width, page_height,
    notation_direction, chant_rows, unpaired_lyric_rows, non_score_regions.
    """
    pages = found.select("page", "page_width", "page_height", "direction").distinct()
    size = F.col("page_height")
    reach = F.greatest(F.lit(125), F.floor(size * 0.07))
    order = Window.partitionBy("page").orderBy("y1", "x1", "y2", "x2")
    all_ = materialise(_kinds(found.where("x1 is not null").withColumn("id", F.row_number().over(order))), "bands")

    # seeds: notation bands, and isolated ones with a text close below (JN13)
    s, c = _renamed(all_, "s"), _renamed(all_, "c").drop("page_height")
    gap = F.col("cy1") - F.col("sy2")
    lone = s.where("not snotation and slong >= 1 and slong_width >= 60 and sn <= 8 and sx2 - sx1 <= 700")
    lone = lone.join(c, "page").where((F.col("sid") != F.col("cid")) & F.col("ctext") & (gap >= 8) & (gap <= reach) & (width_share("s", "c") >= 0.05)).select("page", "sid").distinct()
    seeds = s.where("snotation").unionByName(s.join(lone, ["page", "sid"], "left_semi"))

    # what each seed absorbs: low marks above it (JN14); a weak seed that is such a mark counts itself again
    mark = is_modifier("cn", "clong", F.col("cy2") - F.col("cy1"), "page_height")
    above = (centre("cy1", "cy2") <= centre("sy1", "sy2")) & (F.col("sy1") - F.col("cy2") <= F.greatest(F.lit(28), F.floor(size * 0.025)))
    taken = seeds.join(c, "page").where(~F.col("cnotation") & above & mark).select("page", "page_height", "sid", *[F.col(f"c{k}").alias(k) for k in ("id", "x1", "y1", "x2", "y2", *_COUNTS, "ink")])
    parts = materialise(seeds.select("page", "page_height", "sid", *[F.col(f"s{k}").alias(k) for k in ("id", "x1", "y1", "x2", "y2", *_COUNTS, "ink")]).unionByName(taken), "parts")
    grown = merged(parts, ["page", "page_height", "sid"])
    grown = grown.withColumns({"y1": F.greatest(F.lit(0), F.col("y1") - F.greatest(F.lit(12), F.floor(size * 0.008)).cast("int")), "y2": F.least(size, F.col("y2") + F.greatest(F.lit(24), F.floor(size * 0.012)).cast("int"))})
    strong = grown.join(all_.select("page", F.col("id").alias("sid"), "notation"), ["page", "sid"]).withColumn("weak", ~F.col("notation")).drop("notation")
    rows = merged(merge_overlapping(strong, ["page"], ["weak", "sid"]), ["page", "band_index"])
    rows = materialise(rows.withColumn("row_id", F.row_number().over(Window.partitionBy("page").orderBy("y1", "band_index")) - 1).drop("band_index"), "rows")

    # texts: the other text bands, merged (GRD3), without those within a row's box (JN12)
    source = parts.select("page", "x1", "y1", "x2", "y2").distinct()
    free = all_.where("text").join(source, ["page", "x1", "y1", "x2", "y2"], "left_anti").withColumn("gap", F.greatest(F.lit(10), F.floor(size * 0.01)))
    texts = _kinds(merged(merge_bands(free, ["page"], ["id"], "gap"), ["page", "page_height", "band_index"]).withColumnRenamed("band_index", "text_id"))
    box = rows.select(F.col("page").alias("rpage"), *[F.col(k).alias(f"r{k}") for k in ("x1", "y1", "x2", "y2")])
    share = overlap("y1", "y2", "ry1", "ry2") / F.greatest(F.lit(1), F.col("y2") - F.col("y1"))
    small = F.col("x2") - F.col("x1") <= F.greatest(F.lit(45), F.floor((F.col("rx2") - F.col("rx1")) * 0.25))
    inside = (overlap("y1", "y2", "ry1", "ry2") > 0) & (share >= 0.35) & ((centre("y1", "y2") <= centre("ry1", "ry2")) | ((share >= 0.5) & small))
    texts = materialise(texts.join(box, (F.col("page") == F.col("rpage")) & inside, "left_anti"), "texts")

    readable = texts.where("text").select("page", "page_height", "text_id", "y1", "y2")
    routed = pair_texts(rows.select("page", "row_id", "y1", "y2"), readable, ["page"], "row_id", "text_id", reach, size)
    routed = texts.join(routed, ["page", "text_id"], "left").withColumn("route", F.coalesce("route", F.lit("non_score")))
    kind = F.when(F.col("route") == "non_score", "non_score").otherwise("lyrics")
    region = F.struct(kind.alias("kind"), F.array("x1", "y1", "x2", "y2").alias("bbox"), F.col("n").alias("component_count"), F.col("long").alias("long_component_count"), F.col("ink").alias("ink_ratio"), F.lit("unknown").alias("script"), F.lit("unknown").alias("text_direction"))
    routed = routed.select("page", "row_id", "route", "text_id", region.alias("region"))

    def gathered(which: str) -> Column:
        items = F.array_sort(F.collect_list(F.when(F.col("route") == which, F.struct("text_id", "region"))))
        return F.transform(items, lambda x: x["region"])

    lyrics = routed.where("route = 'lyrics'").groupBy("page", "row_id").agg(gathered("lyrics").alias("lyric_rows"))
    empty = F.array().cast(lyrics.schema["lyric_rows"].dataType)
    full = rows.join(lyrics, ["page", "row_id"], "left").join(pages.select("page", "direction"), "page")
    row = F.struct(F.col("row_id").alias("index"), F.array("x1", "y1", "x2", "y2").alias("bbox"), F.col("direction").alias("notation_direction"), F.coalesce("lyric_rows", empty).alias("lyric_rows"))
    chant = full.groupBy("page").agg(F.array_sort(F.collect_list(row)).alias("chant_rows"))
    others = routed.groupBy("page").agg(gathered("unpaired").alias("unpaired_lyric_rows"), gathered("non_score").alias("non_score_regions"))
    out = pages.join(chant, "page", "left").join(others, "page", "left")
    none = F.array().cast(chant.schema["chant_rows"].dataType)
    return out.select("page", "page_width", "page_height", F.col("direction").alias("notation_direction"), F.coalesce("chant_rows", none).alias("chant_rows"), F.coalesce("unpaired_lyric_rows", empty).alias("unpaired_lyric_rows"), F.coalesce("non_score_regions", empty).alias("non_score_regions"))


@scoped
def segment(pages: DataFrame, direction: str = "ltr", least: int = 3) -> DataFrame:
    """Layout of page images; the pixels are read in one map, and only bands are joined."""
    return layout(materialise(bands(pages, direction, least), "found"))


def layout_mask(row, pad: int = 8) -> np.ndarray:
    """IMG8: 255 on the padded rows of a layout, 0 on their texts; later rows may paint over earlier texts."""
    mask = np.zeros((row.page_height, row.page_width), np.uint8)
    for r in row.chant_rows:
        mask[max(0, r.bbox[1] - pad) : min(row.page_height, r.bbox[3] + pad)] = 255
        for text in r.lyric_rows:
            mask[text.bbox[1] : text.bbox[3]] = 0
    return mask


def layout_metrics(layouts: DataFrame) -> DataFrame:
    """AGG18: rows, paired texts and unpaired texts of every page."""
    paired = F.aggregate("chant_rows", F.lit(0), lambda n, r: n + F.size(r["lyric_rows"]))
    return layouts.select("page", F.size("chant_rows").alias("rows"), paired.alias("lyrics"), F.size("unpaired_lyric_rows").alias("unpaired"))
