"""Rows of detections and their reading order (GRD2, AGG13, WIN11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.boxes import centre
from inkmill.operators.folds import row_groups


def detection_rows(detections: DataFrame, page: list[str], order: str = "ord", tolerance: float = 20.0) -> DataFrame:
    """GRD2: detections with x_center, y_center and the number of their row."""
    placed = detections.withColumns({"x_center": centre("x1", "x2"), "y_center": centre("y1", "y2")})
    return row_groups(placed, page, "y_center", [order], tolerance)


def row_directions(rows: DataFrame, page: list[str], width: str | None = None, default: str = "ltr", overrides: DataFrame | None = None) -> DataFrame:
    """AGG13: each row's direction: an override, or rtl where its mean x lies right of the page's middle, or ``default`` without a page width.

    ``overrides``: page columns, row_index, override.
    """
    by_row = rows.groupBy(*page, "row_index").agg(F.avg("x_center").alias("_x"), (F.max(width) if width else F.lit(None).cast("double")).alias("_w"))
    if overrides is not None:
        by_row = by_row.join(overrides.select(*page, "row_index", "override"), [*page, "row_index"], "left")
    else:
        by_row = by_row.withColumn("override", F.lit(None).cast("string"))
    side = F.when(F.col("_w") > 0, F.when(F.col("_x") > F.col("_w") / 2, "rtl").otherwise("ltr")).otherwise(default)
    return by_row.select(*page, "row_index", F.coalesce("override", side).alias("direction"))


def reading_order(detections: DataFrame, page: list[str], order: str = "ord", width: str | None = None, default: str = "ltr", overrides: DataFrame | None = None, tolerance: float = 20.0) -> DataFrame:
    """WIN11: detections with row_index, direction and place (from 0 on the page): rows from the top, each in its direction, ties as they came."""
    rows = detection_rows(detections, page, order, tolerance)
    sided = rows.join(row_directions(rows, page, width, default, overrides), [*page, "row_index"])
    along = F.when(F.col("direction") == "rtl", -F.col("x_center")).otherwise(F.col("x_center"))
    place = F.row_number().over(Window.partitionBy(*page).orderBy("row_index", along, order)) - 1
    return sided.withColumn("place", place)
