"""Box geometry and band predicates as column expressions (PRJ18, PRJ20, PRJ23-26, FLT6-13).

Boxes are half-open: x1 <= x < x2, y1 <= y < y2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def overlap(a1, a2, b1, b2) -> Column:
    """Length two intervals share, not below 0."""
    return F.greatest(F.lit(0), F.least(_c(a2), _c(b2)) - F.greatest(_c(a1), _c(b1)))


def centre(low, high) -> Column:
    return (_c(low) + _c(high)) / 2


def width_share(a: str, b: str) -> Column:
    """PRJ24: shared width over the narrower box's width. ``a`` and ``b`` are column prefixes."""
    narrow = F.least(_c(f"{a}x2") - _c(f"{a}x1"), _c(f"{b}x2") - _c(f"{b}x1"))
    return overlap(f"{a}x1", f"{a}x2", f"{b}x1", f"{b}x2") / F.greatest(F.lit(1), narrow)


def iou(a: str, b: str) -> Column:
    """PRJ25: intersection over union of boxes given as x, y, w, h under two column prefixes; 0 for an empty union."""
    inter = overlap(f"{a}x", _c(f"{a}x") + _c(f"{a}w"), f"{b}x", _c(f"{b}x") + _c(f"{b}w")) * overlap(f"{a}y", _c(f"{a}y") + _c(f"{a}h"), f"{b}y", _c(f"{b}y") + _c(f"{b}h"))
    union = _c(f"{a}w") * _c(f"{a}h") + _c(f"{b}w") * _c(f"{b}h") - inter
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)


def padded(x: Column | int, y: Column | int, width, height) -> list[Column]:
    """PRJ23: the box x1, y1, x2, y2 grown by x and y and clamped to the page."""
    x, y = F.lit(x), F.lit(y)
    return [F.greatest(F.lit(0), _c("x1") - x).alias("x1"), F.greatest(F.lit(0), _c("y1") - y).alias("y1"), F.least(_c(width), _c("x2") + x).alias("x2"), F.least(_c(height), _c("y2") + y).alias("y2")]


def pt_to_px(pt, dpi: int = 300) -> Column:
    """PRJ26: points to pixels, half to even, at least 4."""
    return F.greatest(F.lit(4), F.bround(_c(pt) * dpi / 72).cast("int"))


def percent_to_centre(x, y, width, height) -> list[Column]:
    """PRJ18: a percent box to centre and size in 0..1, each clamped."""

    def clamp(v: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))

    x, y, width, height = map(_c, (x, y, width, height))
    return [clamp((x + width / 2) / 100).alias("x_center"), clamp((y + height / 2) / 100).alias("y_center"), clamp(width / 100).alias("width"), clamp(height / 100).alias("height")]


def yolo_line(class_id, *box) -> Column:
    """PRJ19: ``class x y w h`` with six decimals."""
    return F.format_string("%d %.6f %.6f %.6f %.6f", _c(class_id), *map(_c, box))


def pixels_to_percent(x, y, w, h, page_width, page_height) -> list[Column]:
    """PRJ20: a pixel box to percent of the page, four decimals."""
    pw, ph = _c(page_width), _c(page_height)
    return [F.round(_c(v) / size * 100, 4).alias(n) for n, v, size in (("x", x, pw), ("y", y, ph), ("width", w, pw), ("height", h, ph))]


def is_long(width, height, page_width, page_height, *, masking: bool = False) -> Column:
    """FLT7: a long, low component; the masking pass has slightly wider limits."""
    least, share, tallest = (18, 0.012, 10) if masking else (12, 0.01, 8)
    w, h = _c(width), _c(height)
    wide = w >= F.greatest(F.lit(least), F.floor(_c(page_width) * share))
    low = h <= F.greatest(F.lit(tallest), F.floor(_c(page_height) * 0.025))
    return wide & low & (w / h >= 3)


def is_notation(n, long, long_width, width) -> Column:
    """FLT8: a band of notation, by its counts of components and of long ones."""
    n, long, long_width, width = map(_c, (n, long, long_width, width))
    few = n <= 18
    return (
        F.when(n > 75, False)
        .when((long >= 3) & (long_width >= 300), few | (long / n >= 0.32))
        .when((width < 300) & (long >= 3) & (long_width >= 90), True)
        .otherwise(few & (long >= 5) & (long_width >= 220))
    )


def is_text(n, width, height, notation: Column) -> Column:
    """FLT9: a band that reads as text."""
    return ~notation & ((_c(n) >= 2) | (_c(width) >= 40)) & (_c(height) >= 4)


def is_modifier(n, long, height, page_height) -> Column:
    """FLT10: a low band of few components, as marks above a notation row are."""
    return ((_c(n) <= 4) | ((_c(n) <= 6) & (_c(long) >= 1))) & (_c(height) <= F.greatest(F.lit(24), F.floor(_c(page_height) * 0.025)))


def is_probable_row(total, long, long_width) -> Column:
    """FLT11: a row that the text mask should keep."""
    total, long, long_width = map(_c, (total, long, long_width))
    return F.when(total > 85, False).when((long >= 8) & (long_width >= 300), True).otherwise((long >= 3) & (long_width >= 150) & (total <= 75))


def audit_passed(expected, ink_ratio, least_content: float = 0.0008, most_blank: float = 0.0003) -> Column:
    """FLT13: content pages need ink, blank ones must lack it; any other expectation raises."""
    e, r = _c(expected), _c(ink_ratio)
    return F.when(e == "content", r >= least_content).when(e == "blank", r <= most_blank).otherwise(F.raise_error(F.concat(F.lit("unknown expectation: "), e)).cast("boolean"))


def template_fits(area, ink, row_spread, ink_rows, width, height) -> Column:
    """FLT3: a template with enough shape to be matched, from its metric columns (FLT4)."""
    ratio = _c(width) / _c(height)
    return (_c(area) >= 80) & _c(ink).between(0.04, 0.55) & (_c(row_spread) >= 0.08) & (_c(ink_rows) >= 4) & ratio.between(0.3, 3.5)
