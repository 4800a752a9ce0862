"""Text, path and code-point expressions (PRJ1, PRJ4-5, PRJ7-12, PRJ16-17, PRJ27-29, FLT1-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default code-point ranges of notation glyphs.
GLYPH_RANGES = ((0x21, 0x7E), (0x112, 0x174), (0xE0D0, 0xE127))


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def page_path(root: str, book, page) -> Column:
    """PRJ1: root/book/page_0001.png; longer numbers stay whole."""
    return F.format_string("%s/%s/page_%04d.png", F.lit(root), _c(book), _c(page))


def checked_direction(value, *, auto: bool = True) -> Column:
    """PRJ4: lower-cased direction; anything outside the domain raises."""
    v = F.lower(_c(value))
    return F.when(v.isin("ltr", "rtl", *(["auto"] if auto else [])), v).otherwise(F.raise_error(F.concat(F.lit("unknown direction: "), F.coalesce(v, F.lit("null")))).cast("string"))


def resolve_direction(pages: DataFrame, directions: DataFrame, default: str = "ltr", book: str = "book_id", page: str = "page_number") -> DataFrame:
    """PRJ5: pages with ``direction`` by page number, page name, book default, then ``default``.

    ``directions``: book, key, direction. One aggregation of the map by book and
    one join, whatever number of keys a book has.
    """
    by_book = directions.groupBy(F.col("book").alias("_book")).agg(F.map_from_entries(F.collect_set(F.struct("key", "direction"))).alias("_map"))
    number = F.col(page).cast("string")
    found = F.coalesce(F.col("_map")[number], F.col("_map")[F.format_string("page_%04d", F.col(page))], F.col("_map")["default"], F.lit(default))
    return pages.join(by_book, pages[book] == by_book["_book"], "left").withColumn("direction", found).drop("_book", "_map")


def codepoint_key(cp) -> Column:
    """PRJ7: U+0041 and so on; five digits stay whole."""
    return F.format_string("U+%04X", _c(cp))


def parse_codepoint(key) -> Column:
    """PRJ7: U+, 0x or bare hex to a number; empty text raises."""
    digits = F.regexp_replace(F.upper(F.trim(_c(key))), "^(U\\+|0X)", "")
    return F.when(digits == "", F.raise_error(F.lit("empty code point")).cast("int")).otherwise(F.conv(digits, 16, 10).cast("int"))


def normal_key(key) -> Column:
    return codepoint_key(parse_codepoint(key))


def parse_ranges(specs: DataFrame, column: str = "spec") -> DataFrame:
    """PRJ8: A-B or A in hex to inclusive (lo, hi); a descending range raises."""
    parts = F.split(F.upper(F.trim(column)), "-", 2)
    lo = parse_codepoint(parts[0])
    hi = F.when(F.size(parts) > 1, parse_codepoint(parts[1])).otherwise(lo)
    return specs.withColumns({"lo": lo, "hi": F.when(hi < lo, F.raise_error(F.lit("descending range")).cast("int")).otherwise(hi)})


def in_ranges(cp, ranges=GLYPH_RANGES) -> Column:
    """PRJ9, FLT2: in one of the ranges; no range means no limit."""
    cp, out = _c(cp), F.lit(not ranges)
    for lo, hi in ranges or ():
        out = out | cp.between(lo, hi)
    return out


def class_group(name) -> Column:
    """PRJ10: what stands before the first dot."""
    return F.substring_index(_c(name), ".", 1)


def class_icon(name) -> Column:
    """PRJ10: what stands after the first dot; the whole name without one."""
    return F.regexp_replace(_c(name), r"^[^.]*\.", "")


def book_of_label(path) -> Column:
    """PRJ11: the folder of a label file, or the one above where that is a split's name."""
    parts = F.split(_c(path), "/")
    parent = F.try_element_at(parts, F.lit(-2))
    return F.when(parent.isin("labels", "train", "val", "test"), F.coalesce(F.try_element_at(parts, F.lit(-3)), parent)).otherwise(parent)


def class_name(group, icon) -> Column:
    """PRJ12: class name of a symbol by its group."""
    g, i = _c(group), _c(icon)
    return F.concat(F.when(g == "neume", F.lit("base_neume")).when(g.isin("gorgon", "modulation", "isson"), F.concat(F.lit("modifier_"), g)).otherwise(g), F.lit("."), i)


def image_path(url, root: str) -> Column:
    """PRJ16: where a task's image lies: file URLs, web URLs by base name, local-file queries, absolute paths, or under ``root``."""
    u = _c(url)
    query = F.regexp_extract(u, "[?&]d=([^&]*)", 1)
    base = F.regexp_extract(F.regexp_replace(u, "[?#].*$", ""), "([^/]*)$", 1)
    decoded = F.url_decode(F.replace(base, F.lit("+"), F.lit("%2B")))
    return (
        F.when(u.startswith("file:"), F.regexp_replace(F.url_decode(F.replace(u, F.lit("+"), F.lit("%2B"))), "^file:(//)?", ""))
        .when(u.startswith("http://") | u.startswith("https://"), F.concat(F.lit(f"{root}/"), decoded))
        .when(u.startswith("/data/local-files/"), F.concat(F.lit(f"{root}/"), F.url_decode(query)))
        .when(u.startswith("/"), u)
        .otherwise(F.concat(F.lit(f"{root}/"), u))
    )


def local_file_url(path, root: str, *, strict: bool = True) -> Column:
    """PRJ17: the served URL of a path under ``root``, not percent-encoded; paths outside raise, or stay as they are."""
    p = _c(path)
    outside = F.raise_error(F.concat(F.lit("outside the root: "), p)).cast("string") if strict else p
    return F.when(p.startswith(f"{root}/"), F.concat(F.lit("/data/local-files/?d="), F.substring(p, len(root) + 2, 1 << 30))).otherwise(outside)


def parse_page_ranges(specs: DataFrame, column: str = "spec") -> DataFrame:
    """PRJ27: a list such as 5-7,2 to one row per distinct page, column ``page``; pages below 1 and descending ranges raise."""
    piece = F.explode(F.split(F.col(column), ","))
    rows = specs.withColumn("_piece", piece).withColumn("_piece", F.trim("_piece")).where("_piece <> ''")
    ends = F.split("_piece", "-", 2)
    lo, hi = ends[0].cast("int"), F.coalesce(F.try_element_at(ends, F.lit(2)), ends[0]).cast("int")
    bad = (lo < 1) | (hi < lo)
    pages = F.when(bad, F.raise_error(F.concat(F.lit("bad page range: "), F.col("_piece"))).cast("array<int>")).otherwise(F.sequence(lo, hi))
    return rows.withColumn("page", F.explode(pages)).drop("_piece").distinct()


def pages_from_bounds(first, last, total) -> Column:
    """PRJ28: the array of page numbers within bounds, clamped to the page count; 0 and null count as unset."""
    lo = F.coalesce(F.nullif(_c(first), F.lit(0)), F.lit(1))
    hi = F.least(F.coalesce(F.nullif(_c(last), F.lit(0)), _c(total)), _c(total))
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def parse_assignments(texts: list[str]) -> dict[str, float]:
    """PRJ29: Name=0.8 options to a map, the last one winning."""
    out = {}
    for text in texts:
        name, found, value = text.partition("=")
        if not found:
            raise ValueError(f"not an assignment: {text}")
        out[name.strip()] = float(value)
    return out


def is_blank_page(ink_ratio) -> Column:
    """FLT1: ink ratio of zero; missing or empty counts as one."""
    return F.coalesce(F.nullif(F.trim(_c(ink_ratio).cast("string")), F.lit("")).cast("double"), F.lit(1.0)) == 0
