"""Writers (SNK1-SNK22).

Tables of any size are written by Spark as folders of CSV or JSON. Reports,
configuration files and single-file exports are for result tables: their rows
are read by the driver, at most ``MAX_ROWS`` of them, and more raise.
"""

from __future__ import annotations

import html
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill import schemas
from inkmill.functions.text import codepoint_key
from inkmill.operators.annotate import label_elements
from inkmill.operators.manifest import upsert
from inkmill.operators.stats import frequencies, nearest
from inkmill.operators.work import broadcast_if_small
from inkmill.sources.files import read_manifest

MAX_ROWS = 200_000


def rows_of(df: DataFrame) -> list:
    """The rows of a result table."""
    rows = df.limit(MAX_ROWS + 1).collect()
    if len(rows) > MAX_ROWS:
        raise ValueError(f"more than {MAX_ROWS} rows for a single file")
    return rows


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One UTF-8 file in any store, written beside its place and then moved there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(path + ".part")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(beside, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    store.delete(target, False)
    store.rename(beside, target)


def _jsonable(row) -> dict:
    return row.asDict(recursive=True)


def write_json(df: DataFrame, path: str, key: str | None = None, extra: dict | None = None) -> None:
    """A JSON array of rows, or an object with them under ``key`` beside ``extra``."""
    rows = [_jsonable(r) for r in rows_of(df)]
    write_text(df.sparkSession, path, json.dumps({**(extra or {}), key: rows} if key else rows, ensure_ascii=False, indent=2) + "\n")


def write_manifest(spark: SparkSession, path: str, new: DataFrame) -> None:
    """SNK1: upsert pages into a manifest folder.

    The new version is complete beside the old one before the old one is moved
    away; where a crash leaves no manifest at its path, readers find the new one.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path
    target, fresh, old = place(path), place(path + ".next"), place(path + ".old")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    columns = [c.split()[0] for c in schemas.MANIFEST.split(", ")]
    rows = upsert(read_manifest(spark, path), new.select(*columns), ["book_id", "page_number"]) if store.exists(target) or store.exists(place(path + ".next/_SUCCESS")) else new.select(*columns)
    rows.orderBy("book_id", "page_number").write.mode("overwrite").option("header", "true").csv(path + ".new")
    store.delete(fresh, True)
    store.rename(place(path + ".new"), fresh)
    store.delete(old, True)
    if store.exists(target):
        store.rename(target, old)
    store.rename(fresh, target)
    store.delete(old, True)


def write_pages(rendered: DataFrame) -> None:
    """SNK2: PNG files at image_path, which must be on a file system that all executors mount."""

    def put(rows: Iterator) -> None:
        import os

        for r in rows:
            os.makedirs(os.path.dirname(r.image_path), exist_ok=True)
            with open(r.image_path + ".part", "wb") as f:
                f.write(r.png)
            os.replace(r.image_path + ".part", r.image_path)

    rendered.select("image_path", "png").foreachPartition(put)


def write_layouts(layouts: DataFrame, path: str, html_path: str | None = None) -> None:
    """SNK3, SNK4: layouts as JSON, and as boxes over the pages in HTML."""
    write_json(layouts, path, "pages")
    if html_path:
        write_text(layouts.sparkSession, html_path, layout_html(rows_of(layouts)))


def layout_html(rows: list) -> str:
    def box(row, b: list, kind: str) -> str:
        left, top, width, height = (100 * v / s for v, s in ((b[0], row.page_width), (b[1], row.page_height), (b[2] - b[0], row.page_width), (b[3] - b[1], row.page_height)))
        return f'<i class="{kind}" style="left:{left:.3f}%;top:{top:.3f}%;width:{width:.3f}%;height:{height:.3f}%"></i>'

    out = ["<!doctype html><meta charset=utf-8><style>figure{position:relative}img{width:100%}i{position:absolute;border:1px solid}.chant{color:#06c}.lyrics{color:#090}.unpaired{color:#c60}.non_score{color:#999}</style>"]
    for r in rows:
        boxes = [box(r, c.bbox, "chant") + "".join(box(r, t.bbox, "lyrics") for t in c.lyric_rows) for c in r.chant_rows]
        boxes += [box(r, t.bbox, "unpaired") for t in r.unpaired_lyric_rows] + [box(r, t.bbox, "non_score") for t in r.non_score_regions]
        counts = f"rows {len(r.chant_rows)}, lyrics {sum(len(c.lyric_rows) for c in r.chant_rows)}, unpaired {len(r.unpaired_lyric_rows)}"
        out.append(f'<h2>{html.escape(r.page)}</h2><p>{counts}</p><figure><img src="{html.escape(r.page)}">{"".join(boxes)}</figure>')
    return "\n".join(out)


def groups_json(groups: DataFrame, shapes: DataFrame, icons: DataFrame) -> DataFrame:
    """SNK5, PRJ31: groups with their members' names and icons. ``shapes``: id, glyph_name; ``icons``: key, icons."""
    listed = groups.select(F.col("id").alias("group"), "representative", F.posexplode("members").alias("pos", "key"))
    joined = listed.join(shapes.select(F.col("id").alias("key"), "glyph_name"), "key", "left").join(icons.select("key", "icons"), "key", "left")
    member = F.struct("pos", codepoint_key("key").alias("codepoint"), F.col("glyph_name").alias("glyphName"), F.coalesce("icons", F.array().cast("array<string>")).alias("icons"))
    return joined.groupBy(F.col("group").alias("id"), codepoint_key("representative").alias("representative")).agg(F.transform(F.array_sort(F.collect_list(member)), lambda m: m.dropFields("pos")).alias("members"))


def matches_json(found: DataFrame) -> DataFrame:
    """SNK6: detections nested by page, scores to four decimals."""
    d = F.struct("ord", F.col("label").alias("groupId"), "x", "y", F.col("w").alias("width"), F.col("h").alias("height"), F.round("score", 4).alias("score"), F.col("pt").alias("sizePt"))
    return found.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(d)), lambda x: x.dropFields("ord")).alias("detections"))


def write_detections(found: DataFrame, groups: DataFrame, path: str) -> None:
    """SNK7: flat detections as CSV, group members joined by spaces. ``groups``: id, representative, members."""
    keys = F.array_join(F.transform("members", lambda k: codepoint_key(k)), " ")
    named = broadcast_if_small(groups.select(F.col("id").alias("label"), codepoint_key("representative").alias("representative"), keys.alias("members")))
    out = found.join(named, "label").select("page", F.col("label").alias("group_id"), "representative", "x", "y", F.col("w").alias("width"), F.col("h").alias("height"), "score", F.col("pt").alias("size_pt"), "members")
    out.write.mode("overwrite").option("header", "true").csv(path)


def match_report(groups: DataFrame, counts: DataFrame, names: DataFrame) -> str:
    """SNK8: groups by falling count as HTML. ``counts``: label, n; ``names``: id, icons."""
    rows = groups.join(counts.select(F.col("label").alias("id"), "n"), "id", "left").join(names, "id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rows = rows_of(rows.orderBy(F.desc("n"), "id"))
    most = max([1, *(r.n for r in rows)])
    line = '<tr><td>{}</td><td>{}</td><td><span class="count">{}</span></td><td><div class="bar" style="width:{}px"></div></td><td>{}</td></tr>'
    body = [line.format(r.id, html.escape(", ".join(dict.fromkeys(r.icons or []))), r.n, round(180 * r.n / most), " ".join(f"U+{k:04X}" for k in r.members)) for r in rows]
    return "<!doctype html><meta charset=utf-8><table>" + "".join(body) + "</table>"


def frequency_report(table: DataFrame) -> tuple[str, str]:
    """SNK9, SNK10: the frequency table (label, n, per_page, pct, rank) as HTML, found and unfound apart, and its first forty rows as text."""
    rows = rows_of(table.orderBy("rank"))
    most = max([1, *(r.n for r in rows)])
    cell = '<tr><td>{}</td><td>{}</td><td>{}</td><td>{}</td><td><div style="width:{}%"></div></td></tr>'
    parts = ["".join(cell.format(r["rank"], html.escape(r.label), r.n, r.pct, int(100 * r.n / most)) for r in rows if (r.n > 0) == found) for found in (True, False)]
    console = "\n".join(f"{r['rank']:>4} {r.label:<24} {r.n:>8} {'#' * max(1, min(20, int(20 * r.n / most)))}" for r in rows[:40])
    return f"<!doctype html><meta charset=utf-8><h2>Found</h2><table>{parts[0]}</table><h2>Not found</h2><table>{parts[1]}</table>", console


#: Members that a similarity map shows.
HEAT_MEMBERS = 80


def family_report(families: DataFrame, pairs: DataFrame | None = None, heat: int = HEAT_MEMBERS) -> str:
    """SNK11: families as HTML, with a similarity map of the first ``heat`` members if pairs (a, b, sim) are given."""
    rows = rows_of(families.orderBy("id"))
    out = ["<!doctype html><meta charset=utf-8><ul>", *(f"<li>{r.id}: {' '.join(f'U+{k:04X}' for k in r.members)}</li>" for r in rows), "</ul>"]
    if pairs is not None:
        keys = [k for r in rows for k in r.members][:heat]
        sims = {(r.a, r.b): r.sim for r in rows_of(pairs.where(F.col("a").isin(keys) & F.col("b").isin(keys)))}
        grid = ["".join(f'<td style="background:rgba(0,90,200,{max(0.0, 1.0 if a == b else sims.get((min(a, b), max(a, b)), 0.0)):.2f})"></td>' for b in keys) for a in keys]
        out.append("<table>" + "".join(f"<tr>{g}</tr>" for g in grid) + "</table>")
    return "".join(out)


def write_label_files(lines: DataFrame, path: str, split: str = "train") -> None:
    """SNK12: one text per image stem, as rows (stem, value) in folders by split; of equal stems the last image's stays."""
    stem = F.regexp_extract("image", r"([^/]*?)(\.[^./]*)?$", 1)
    last = lines.groupBy(stem.alias("stem")).agg(F.max_by("lines", "image").alias("value"))
    last.withColumn("split", F.lit(split)).write.mode("overwrite").partitionBy("split", "stem").text(path)


def write_yaml(spark: SparkSession, path: str, payload: dict) -> None:
    """SNK13, SNK19, SNK20: a configuration file."""
    import yaml

    write_text(spark, path, yaml.safe_dump(payload, sort_keys=False, allow_unicode=True))


def dataset_yaml(classes: DataFrame, root: str) -> dict:
    """SNK13: the description of a detection data set."""
    return {"path": root, "train": "images/train", "val": "images/val", "names": {r.class_id: r.name for r in rows_of(classes.orderBy("class_id"))}}


def proposals_yaml(proposals: DataFrame, parameters: dict) -> dict:
    """SNK19: alias proposals with the parameters they come from."""
    return {"source": parameters, "proposals": [{"representative": f"U+{r.base:04X}", "members": [f"U+{m:04X}" for m in r.members]} for r in rows_of(proposals)]}


def classes_yaml(classes: DataFrame) -> dict:
    """SNK20: class names in order, and the classes of each group."""
    rows, groups = rows_of(classes.orderBy("class_id")), {}
    for r in rows:
        groups.setdefault(r.group, []).append(r.name)
    return {"names": [r.name for r in rows], "groups": groups}


def write_tasks(tasks: DataFrame, path: str) -> None:
    """SNK14, SNK15: annotation tasks, with predictions where there are any, as a JSON array."""
    data = F.struct(*tasks.columns[:4])
    extra = [F.array(F.struct("result", "score")).alias("predictions")] if "result" in tasks.columns else []
    write_json(tasks.select(data.alias("data"), *extra), path)


#: The labelling interface around its labels.
LABEL_VIEW = """<View>
  <Image name="image" value="$image" zoom="true" zoomControl="true" rotateControl="false"/>
  <RectangleLabels name="label" toName="image" strokeWidth="2" canRotate="false">
{}
  </RectangleLabels>
</View>
"""


def label_config(classes: DataFrame) -> str:
    """SNK16: the labelling interface's XML."""
    elements = "\n".join(f"    {r.element}" for r in rows_of(label_elements(classes).orderBy("class_id")))
    return LABEL_VIEW.format(elements)


def label_statistics(boxes: DataFrame) -> dict[str, DataFrame]:
    """AGG1-AGG4, JN6: the four statistics tables of label boxes."""
    rows = boxes.withColumn("box", F.struct("page_id", "number"))
    base = rows.where("group = 'base_neume'").select("book_id", "page_id", F.col("number").alias("base"), F.col("icon").alias("base_icon"), "x_center", "y_center")
    mark = rows.where(F.col("group").startswith("modifier_")).select("book_id", "page_id", "number", "x_center", "y_center")
    near = nearest(mark, base, ["book_id", "page_id"], "number", "base", ["x_center", "y_center"])
    named = near.join(base.select("book_id", "page_id", "base", "base_icon"), ["book_id", "page_id", "base"]).join(rows.select("book_id", "page_id", "number", F.col("icon").alias("modifier_icon")), ["book_id", "page_id", "number"])
    return {
        "frequency": frequencies(rows, ["class_name", "group", "icon"], count="count", share="percentage"),
        "groups": frequencies(rows, ["group"], count="count", share="percentage"),
        "per_book": frequencies(rows, ["class_name", "group", "icon"], within=["book_id"], count="count", share="percentage"),
        "cooccurrence": frequencies(named, ["base_icon", "modifier_icon"], count="count", share="percentage"),
    }


def write_statistics(boxes: DataFrame, path: str) -> None:
    """SNK17: the four tables as CSV, most frequent first."""
    for name, df in label_statistics(boxes).items():
        df.orderBy(F.desc("count"), *[c for c in df.columns if c not in ("count", "percentage")]).write.mode("overwrite").option("header", "true").csv(f"{path}/{name}")


def write_audit(audited: DataFrame, path: str) -> None:
    """SNK18: image_path, expected, ink_ratio, passed."""
    audited.select("image_path", "expected", "ink_ratio", "passed").write.mode("overwrite").option("header", "true").csv(path)


#: The order of groups on the reference sheet; other groups are left out.
SHEET_GROUPS = ("base_neume", "rest", "modifier_gorgon", "modifier_isson", "modifier_modulation", "mode", "key_signature")


def reference_sheet(classes: DataFrame, thumbnails: DataFrame) -> str:
    """SNK21: classes with thumbnails, by group. ``classes``: class_id, name; ``thumbnails``: icon, url."""
    rows = classes.select("class_id", F.substring_index("name", ".", 1).alias("group"), F.regexp_replace("name", r"^[^.]*\.", "").alias("icon")).join(thumbnails, "icon", "left")
    rows = rows_of(rows.where(F.col("group").isin(*SHEET_GROUPS)).orderBy("class_id"))
    out = ["<!doctype html><meta charset=utf-8>"]
    for group in SHEET_GROUPS:
        cells = "".join(f"<figure>{f'<img src={json.dumps(r.url)}>' if r.url else ''}<figcaption>{r.class_id} {html.escape(r.icon)}</figcaption></figure>" for r in rows if r.group == group)
        if cells:
            out.append(f"<h2>{group}</h2>{cells}")
    return "".join(out)
