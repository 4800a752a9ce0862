"""Annotation exports, label files and predictions (D16-17, SRC16-18, WIN12, PRJ18-21, SNK12, SNK14-16, AGG14, JN3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.boxes import percent_to_centre, pixels_to_percent, yolo_line
from inkmill.functions.text import book_of_label, class_group, class_icon
from inkmill.operators.work import broadcast_if_small

#: Label colours, by class number modulo their count.
PALETTE = ("#1f77b4", "#ff7f0e", "#2ca02c", "#d62728", "#9467bd", "#8c564b", "#e377c2", "#7f7f7f", "#bcbd22", "#17becf")


def latest_result(annotations: str = "annotations") -> Column:
    """WIN12: the results of the last annotation that was not cancelled, or of the last one."""
    valid = F.filter(annotations, lambda a: ~F.coalesce(a["was_cancelled"], F.lit(False)))
    last = F.coalesce(F.try_element_at(valid, F.lit(-1)), F.try_element_at(F.col(annotations), F.lit(-1)))
    return last["result"]


def boxes_from_tasks(tasks: DataFrame, classes: DataFrame, image: str) -> DataFrame:
    """PRJ18: label boxes of annotation tasks: task, image, ord, class_id, x_center, y_center, width, height.

    Only rectangles count, with their first label; a label without a class raises.
    """
    results = tasks.select(F.col("id").alias("task"), F.col(image).alias("image"), F.posexplode(latest_result()).alias("ord", "r")).where("r.type = 'rectanglelabels'")
    boxes = results.select("task", "image", "ord", F.try_element_at("r.value.rectanglelabels", F.lit(1)).alias("name"), "r.value.x", "r.value.y", F.col("r.value.width").alias("w"), F.col("r.value.height").alias("h"))
    joined = boxes.join(broadcast_if_small(classes.select("class_id", "name")), "name", "left")
    missing = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce("name", F.lit("null")))).cast("int")
    return joined.select("task", "image", "ord", F.coalesce("class_id", missing).alias("class_id"), *percent_to_centre("x", "y", "w", "h"))


def label_lines(boxes: DataFrame) -> DataFrame:
    """PRJ19, SNK12: the text of each image's label file: image, lines, in the order of the results."""
    line = yolo_line("class_id", "x_center", "y_center", "width", "height")
    items = F.array_sort(F.collect_list(F.struct("ord", line.alias("line"))))
    return boxes.groupBy("image").agg(F.array_join(F.transform(items, lambda x: x["line"]), "\n").alias("lines"))


def parse_label_lines(lines: DataFrame, classes: DataFrame, path: str = "path", value: str = "value", number: str = "number") -> DataFrame:
    """SRC18, JN3: boxes from label lines; blank lines are skipped, short ones and unknown classes raise with path and line."""
    parts = F.split(F.trim(F.regexp_replace(value, r"\s+", " ")), " ")
    where = F.concat(F.col(path), F.lit(":"), F.col(number).cast("string"))
    rows = lines.where(F.trim(F.regexp_replace(value, r"\s+", " ")) != "").withColumn("_p", F.when(F.size(parts) < 5, F.raise_error(F.concat(F.lit("too few columns at "), where)).cast("array<string>")).otherwise(parts))
    fields = [F.col("_p")[k].cast("double").alias(n) for k, n in enumerate(("x_center", "y_center", "width", "height"), 1)]
    rows = rows.select(path, number, F.col("_p")[0].cast("int").alias("class_id"), *fields, where.alias("_where"))
    joined = rows.join(broadcast_if_small(classes.select("class_id", "name")), "class_id", "left")
    name = F.coalesce("name", F.raise_error(F.concat(F.lit("unknown class at "), F.col("_where"))).cast("string"))
    page = F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)
    return joined.withColumn("class_name", name).select(number, "class_id", "class_name", class_group("class_name").alias("group"), class_icon("class_name").alias("icon"), "x_center", "y_center", "width", "height", book_of_label(path).alias("book_id"), page.alias("page_id"))


def predictions(detections: DataFrame, page: str = "page") -> DataFrame:
    """PRJ20, AGG14: per page, detections as percent results and their mean score, 0 without any.

    ``detections``: page, image, page_width, page_height, ord, label, x, y, w, h, score (all null but the page's for an empty page).
    """
    box = F.struct(*pixels_to_percent("x", "y", "w", "h", "page_width", "page_height"), F.array("label").alias("rectanglelabels"))
    score = F.round("score", 4)
    item = F.when(F.col("label").isNotNull(), F.struct("ord", box.alias("value"), score.alias("score")))
    grouped = detections.groupBy(page, "image").agg(F.array_sort(F.collect_list(item)).alias("result"), F.coalesce(F.avg(score), F.lit(0.0)).alias("score"))
    return grouped


def escaped(text: Column) -> Column:
    """HTML-escaped text, quotes included."""
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def label_elements(classes: DataFrame, name: str = "name", number: str = "class_id") -> DataFrame:
    """SNK16: one XML label element per class: class_id, element."""
    colour = F.element_at(F.array(*map(F.lit, PALETTE)), (F.pmod(F.col(number), F.lit(len(PALETTE))) + 1).cast("int"))
    return classes.select(number, F.concat(F.lit('<Label value="'), escaped(F.col(name)), F.lit('" background="'), colour, F.lit('"/>')).alias("element"))
