"""Command lines of the tools: python -m inkmill.plans.cli TOOL ... (one thin layer over the operators)."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from inkmill.functions.boxes import audit_passed
from inkmill.functions.text import GLYPH_RANGES, in_ranges, local_file_url, pages_from_bounds, parse_assignments, parse_codepoint, parse_page_ranges
from inkmill.operators import annotate, layout, manifest, matching, shapes, stats, taxonomy, validate
from inkmill.operators.work import broadcast_if_small, materialise, scoped
from inkmill.sources import files, sinks

#: Sizes and limits that the tools use unless told otherwise.
SIZES_PT = (6.5, 7.0, 7.5, 8.0, 8.5, 9.0, 9.5)
MATCH_SIZES_PT = (7.0, 8.5, 10.0, 11.5, 13.0)
ICON_LIMITS = {"Apostrofos": (0.65, 35), "Isson2": (0.75, 40), "Oligon": (0.78, 5), "OnePlusOneUp": (0.65, 50)}


def _spark() -> SparkSession:
    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _shape_groups(spark, a):
    ranges = GLYPH_RANGES
    if a.codepoint_range:
        specs = spark.createDataFrame([(s,) for s in a.codepoint_range], "spec string")
        from inkmill.functions.text import parse_ranges

        ranges = tuple((r.lo, r.hi) for r in parse_ranges(specs).collect())
    glyphs = files.read_glyphs(spark, a.glyphs)
    found = matching.glyph_shapes(glyphs, ranges)
    groups = shapes.shape_groups(found, a.shape_threshold, None if a.no_mirror else 48)
    if a.aliases:
        groups = shapes.merge_aliases(groups, files.read_aliases(spark, a.aliases))
    if a.family_alias:
        groups = shapes.merge_aliases(groups, spark.createDataFrame([(k, list(keys)) for k, keys in enumerate(a.family_alias)], "ord int, keys array<long>"))
    return glyphs, found, groups


def _icons(spark, a):
    table = taxonomy.icons_by_codepoint(files.read_symbol_map(spark, a.symbol_map))
    return table.select(F.col("cp").cast("long").alias("key"), F.posexplode("icons").alias("pos", "icon"))


def plan_pages(a) -> None:
    spark = _spark()
    pages = parse_page_ranges(spark.createDataFrame([(a.book, a.pages)], "book_id string, spec string")).select("book_id", F.col("page").alias("page_number"))
    manifest.plan_chunks(pages, files.read_manifest(spark, a.manifest), "book_id", "page_number", a.chunk).orderBy("chunk_first").show(1000, False)


def _hook(name: str):
    """The caller's function, named as module:function."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


@scoped
def render(a) -> None:
    """Draw the pages that the manifest lacks, or all with --force, as PNG files, and add them to the manifest."""
    spark = _spark()
    pdfs = files.pdf_files(spark, a.pdfs)
    counts = files.page_counts(pdfs, _hook(a.page_counter))
    planned = counts.select("book_id", F.explode(pages_from_bounds(F.lit(a.first), F.lit(a.last), "pages")).alias("page_number"))
    known = files.read_manifest(spark, a.manifest, may_be_missing=True)
    chunks = manifest.plan_chunks(planned, known.where("false") if a.force else known, "book_id", "page_number", a.chunk)
    directions = files.read_directions(spark, a.directions) if a.directions else files.directions(spark, {})
    drawn = materialise(files.render_pages(pdfs, chunks, _hook(a.renderer), a.root, directions, a.dpi, a.direction, a.mask), "rendered")
    sinks.write_pages(drawn)
    sinks.write_manifest(spark, a.manifest, drawn.drop("png"))


def draw_glyphs(a) -> None:
    """Glyph tables from fonts, by the caller's engine."""
    spark = _spark()
    fonts = spark.read.format("binaryFile").load(a.font)
    files.font_glyphs(fonts, _hook(a.cmap), _hook(a.renderer), size=a.pixels).write.mode("overwrite").parquet(a.output)


def segment(a) -> None:
    spark = _spark()
    out = layout.segment(files.page_images(spark, a.pages, a.book, a.limit), a.direction, a.min_row_height)
    sinks.write_layouts(out, a.output, a.html)


def match(a) -> None:
    spark = _spark()
    glyphs, found, groups = _shape_groups(spark, a)
    names = shapes.icons_of_groups(groups, _icons(spark, a))
    kept = stats.template_members(groups.join(names, "id"), "OnePlusOneUp").select(F.col("id").alias("label"), F.explode("members").alias("cp"), "icons")
    made = matching.templates(glyphs, kept.select("label", F.col("cp").cast("int").alias("cp")), a.size, a.dpi)
    sized = made.join(names.withColumnRenamed("id", "label"), "label").withColumnRenamed("label", "group_id")
    made = stats.largest_sizes(sized, ["Oligon", "OnePlusOneUp"]).withColumnRenamed("group_id", "label").drop("icons") if not a.all_sizes else made
    limits = spark.createDataFrame([(k, float(t), p) for k, (t, p) in ({} if a.no_icon_thresholds else ICON_LIMITS | {k: (v, 10) for k, v in parse_assignments(a.icon_threshold).items()}).items()], "icon string, threshold double, priority int")
    by_group = stats.group_limits(names.select(F.col("id").alias("group_id"), F.explode_outer("icons").alias("icon")), limits, a.threshold, 10)
    hits = matching.match_groups(files.page_images(spark, a.pages, a.book, a.limit), made, {r.group_id: (r.threshold, 10 if a.score_only_nms else r.priority) for r in sinks.rows_of(by_group)}, a.threshold, a.iou, complex_first=not a.no_complex_first)
    hits = materialise(hits, "matches")
    sinks.write_json(sinks.groups_json(groups, found, _icons(spark, a).groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "icon"))), lambda x: x["icon"]).alias("icons"))), f"{a.output}/groups.json", "groups")
    sinks.write_json(sinks.matches_json(hits), f"{a.output}/matches.json", "pages")
    sinks.write_detections(hits, groups, f"{a.output}/detections")
    sinks.write_text(spark, f"{a.output}/report.html", sinks.match_report(groups, hits.groupBy("label").agg(F.count("*").alias("n")), names))


def count_frequencies(a) -> None:
    spark = _spark()
    pages = files.frequency_pages(files.read_manifest(spark, a.manifest), None if a.all else a.sample, str(a.seed), a.book)
    images = files.page_images(spark, a.pages).join(broadcast_if_small(pages.select("book_id", "page_number")), ["book_id", "page_number"], "left_semi")
    glyphs = files.read_glyphs(spark, a.glyphs).where((F.col("cp") >= 0x20) & in_ranges("cp"))
    made = matching.templates(glyphs, glyphs.select(F.format_string("U+%04X", "cp").alias("label"), "cp"), a.size, a.dpi)
    counts = matching.page_counts(matching.match_cascade(images, made, a.threshold, score_only=True, gradients=not a.no_gradient))
    known = glyphs.select(F.format_string("U+%04X", "cp").alias("label"), "cp")
    if a.families:
        listed = files.read_families(spark, a.families).select("representative", F.posexplode("codepoints").alias("ord", "member"))
        summed = counts.groupBy("label").agg(F.sum("n").alias("n"))
        folded = stats.fold_families(summed, known, listed, "label", "n")
        counts, known = folded.select(F.col("family").alias("label"), "n"), known.join(folded.select(F.col("family").alias("label")), "label", "left_semi")
    table = matching.frequency_table(counts, known, images.select("page").count())
    table.write.mode("overwrite").option("header", "true").csv(f"{a.output}/frequencies")
    page, console = sinks.frequency_report(table)
    sinks.write_text(spark, f"{a.output}/frequencies.html", page)
    print(console)


def families(a) -> None:
    spark = _spark()
    found = matching.glyph_shapes(files.read_glyphs(spark, a.glyphs))
    labelled = shapes.linkage_groups(found.withColumn("part", F.lit(0)), "part", a.threshold)
    grouped = labelled.groupBy(F.col("cluster").alias("representative")).agg(F.array_sort(F.collect_list("id")).alias("members"))
    out = shapes.numbered(grouped, F.element_at("members", 1))
    sinks.write_json(out, f"{a.output}/families.json")
    charted = out.select(F.col("id").alias("family"), F.posexplode("members").alias("pos", "id")).orderBy("family", "pos").limit(sinks.HEAT_MEMBERS).select("id")
    sinks.write_text(spark, f"{a.output}/families.html", sinks.family_report(out, shapes.similar_pairs(found.join(F.broadcast(charted), "id", "left_semi"), 0.0) if a.heat_map else None))


def propose(a) -> None:
    spark = _spark()
    _, found, groups = _shape_groups(spark, a)
    names = shapes.icons_of_groups(groups, _icons(spark, a))
    named = groups.join(names, "id").join(found.select(F.col("id").alias("representative"), "vec"), "representative").select(F.col("representative").alias("id"), "vec", "members", F.size("icons").alias("n"))
    best = shapes.best_bases(named.where("n = 0 and size(members) <= 2"), named.where("n > 0"), a.min_similarity)
    sinks.write_yaml(spark, a.output, sinks.proposals_yaml(shapes.proposals(best, a.limit), {"minSimilarity": a.min_similarity, "shapeThreshold": a.shape_threshold}))


def symbol_statistics(a) -> None:
    spark = _spark()
    sinks.write_statistics(annotate.parse_label_lines(files.label_lines(spark, a.labels), files.read_class_names(spark, a.classes)), a.output)


def import_labels(a) -> None:
    spark = _spark()
    boxes = annotate.boxes_from_tasks(files.read_tasks(spark, a.tasks), files.read_class_names(spark, a.classes), "data.image")
    sinks.write_label_files(annotate.label_lines(boxes), f"{a.output}/labels", a.split)
    sinks.write_yaml(spark, f"{a.output}/dataset.yaml", sinks.dataset_yaml(files.read_class_names(spark, a.classes), a.output))


def export_tasks(a) -> None:
    spark = _spark()
    rows = manifest.task_rows(files.read_manifest(spark, a.manifest), local_file_url("image_path", a.root), skip_blank=not a.blank, limit=a.limit)
    sinks.write_tasks(rows, a.output)


def label_config(a) -> None:
    spark = _spark()
    sinks.write_text(spark, a.output, sinks.label_config(files.read_class_names(spark, a.classes)))


def autolabel(a) -> None:
    spark = _spark()
    pages = files.page_images(spark, a.pages, a.book, a.limit)
    symbols = taxonomy.insert_by_icon(files.read_symbol_map(spark, a.symbol_map))
    labels = symbols.select(F.col("icon").alias("label"), F.expr("ascii(insert)").alias("cp"))
    made = matching.templates(files.read_glyphs(spark, a.glyphs), labels, a.size, a.dpi)
    hits = matching.match_cascade(pages, made, a.threshold)
    sized = pages.select("page", local_file_url("page", a.root, strict=False).alias("image"), F.col("width").alias("page_width"), F.col("height").alias("page_height"))
    sinks.write_json(annotate.predictions(sized.join(hits, "page", "left")), a.output)


def audit(a) -> None:
    spark = _spark()
    pages = files.page_images(spark, a.pages)
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def ink(data, width, height, channels):
        import numpy as np
        import pandas as pd

        from inkmill.functions.kernels import ink_ratio

        return pd.Series([ink_ratio(np.frombuffer(d, np.uint8).reshape(h, w, c)) for d, w, h, c in zip(data, width, height, channels, strict=True)])

    measured = pages.select(F.element_at(F.split("page", "/"), -1).alias("name"), "book_id", ink("data", "width", "height", "channels").alias("ink_ratio"))
    wanted = files.read_audit(spark, a.audit).withColumns({"name": F.element_at(F.split("image_path", "/"), -1), "book_id": F.element_at(F.split("image_path", "/"), -2)})
    rows = wanted.join(measured, ["book_id", "name"]).withColumn("passed", audit_passed("expected", "ink_ratio", a.content, a.blank))
    sinks.write_audit(rows, a.output)
    found = stats.precision(rows, "passed").first().precision
    print(f"precision {found:.3f}")
    if found < a.least:
        raise SystemExit(1)


def gold(a) -> None:
    spark = _spark()
    found = files.gold_compositions(spark, a.gold)
    errors = validate.validate(validate.segments(found, "doc_id", "segments"), validate.grammar(files.read_symbol_map(spark, a.symbol_map)))
    errors.show(1000, False)
    if not validate.gate(found, errors, a.least).first().passed:
        raise SystemExit(1)


def sync(a) -> None:
    spark = _spark()
    built = taxonomy.class_list(files.read_symbol_map(spark, a.symbol_map))
    if a.check:
        changes = taxonomy.drift(files.read_class_names(spark, a.classes), built.select("class_id", "name"), ["class_id"])
        changes.orderBy("class_id").show(1000, False)
        if changes.limit(1).count():
            raise SystemExit(1)
    else:
        sinks.write_yaml(spark, a.classes, sinks.classes_yaml(built))


def sheet(a) -> None:
    spark = _spark()
    icons = files.icon_files(spark, a.icons).select("icon", F.col("path").alias("url"))
    sinks.write_text(spark, a.output, sinks.reference_sheet(files.read_class_names(spark, a.classes), icons))


def _families(text: str) -> tuple[int, ...]:
    """PRJ29: comma-separated code points, at least two."""
    keys = [k for k in text.split(",") if k.strip()]
    if len(keys) < 2:
        raise argparse.ArgumentTypeError("a family has at least two code points")
    return tuple(int(k.strip().upper().removeprefix("U+").removeprefix("0X"), 16) for k in keys)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="inkmill")
    tools = top.add_subparsers(required=True)

    def tool(f, name: str, *options: tuple) -> None:
        p = tools.add_parser(name)
        for flag, kw in options:
            p.add_argument(flag, **kw)
        p.set_defaults(run=f)

    def need(flag):
        return flag, {"required": True}

    def opt(flag, default=None, kind=str, **kw):
        return flag, {"default": default, "type": kind, **kw}

    def on(flag):
        return flag, {"action": "store_true"}

    def many(flag, kind=str, default=None):
        return flag, {"nargs": "*", "type": kind, "default": default or []}

    glyph = (need("--glyphs"), need("--symbol-map"), opt("--aliases"), opt("--shape-threshold", 0.86, float), on("--no-mirror"), many("--codepoint-range"), ("--family-alias", {"action": "append", "type": _families, "default": []}))
    tool(plan_pages, "plan", need("--book"), need("--pages"), need("--manifest"), opt("--chunk", 25, int))
    tool(render, "render", many("--pdfs"), need("--renderer"), need("--page-counter"), need("--root"), need("--manifest"), opt("--directions"), opt("--direction", "ltr"), opt("--dpi", 400, int), opt("--first", 0, int), opt("--last", 0, int), opt("--chunk", 25, int), on("--mask"), on("--force"))
    tool(draw_glyphs, "glyphs", many("--font"), need("--cmap"), need("--renderer"), opt("--pixels", 400, int), need("--output"))
    tool(segment, "segment", many("--pages"), many("--book"), opt("--limit", None, int), opt("--direction", "ltr"), opt("--min-row-height", 3, int), need("--output"), opt("--html"))
    tool(match, "match", *glyph, many("--pages"), many("--book"), opt("--limit", None, int), many("--size", float, list(MATCH_SIZES_PT)), opt("--dpi", 300, int), opt("--threshold", 0.75, float), opt("--iou", 0.3, float), on("--score-only-nms"), many("--icon-threshold"), on("--no-icon-thresholds"), on("--no-complex-first"), on("--all-sizes"), need("--output"))
    tool(count_frequencies, "frequencies", need("--manifest"), need("--glyphs"), many("--pages"), opt("--book"), on("--all"), opt("--sample", 100, int), opt("--seed", 42, int), opt("--families"), on("--no-gradient"), many("--size", float, list(MATCH_SIZES_PT)), opt("--dpi", 300, int), opt("--threshold", 0.65, float), need("--output"))
    tool(families, "families", need("--glyphs"), opt("--threshold", 0.80, float), on("--heat-map"), need("--output"))
    tool(propose, "propose", *glyph, opt("--min-similarity", 0.45, float), opt("--limit", 100, int), need("--output"))
    tool(symbol_statistics, "stats", need("--labels"), need("--classes"), need("--output"))
    tool(import_labels, "import", need("--tasks"), need("--classes"), opt("--split", "train"), need("--output"))
    tool(export_tasks, "tasks", need("--manifest"), need("--root"), on("--blank"), opt("--limit", 0, int), need("--output"))
    tool(label_config, "config", need("--classes"), need("--output"))
    tool(autolabel, "autolabel", need("--glyphs"), need("--symbol-map"), many("--pages"), many("--book"), opt("--limit", None, int), need("--root"), many("--size", float, list(SIZES_PT)), opt("--dpi", 300, int), opt("--threshold", 0.65, float), need("--output"))
    tool(audit, "audit", need("--audit"), many("--pages"), opt("--content", 0.0008, float), opt("--blank", 0.0003, float), opt("--least", 0.9, float), need("--output"))
    tool(gold, "gold", need("--gold"), need("--symbol-map"), opt("--least", 5, int))
    tool(sync, "sync", need("--symbol-map"), need("--classes"), on("--check"))
    tool(sheet, "sheet", need("--classes"), many("--icons"), need("--output"))
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(a)


if __name__ == "__main__":
    main()
