import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill import schemas
from inkmill.operators import matching, stats
from inkmill.plans import cli
from inkmill.sources import files, sinks
from inkmill.sources.images import png
from inkmill.streaming.manifest import keep_manifest, page_stream, windowed_counts


def paper(h, w):
    return np.full((h, w), 255, np.uint8)


def mark(kind):
    t = paper(40, 40)
    if kind:
        t[6:34, 6:12] = t[28:34, 6:34] = 0
    else:
        t[17:23, 4:36] = t[6:17, 17:23] = 0
    return t


@pytest.fixture
def pages(tmp_path):
    """Two books of pages; book one's first page holds two marks of kind 0 and one of kind 1."""
    for book, n in (("one", 2), ("Holy Week", 1)):
        (tmp_path / "pages" / book).mkdir(parents=True)
        for k in range(1, n + 1):
            page = paper(150, 200)
            if (book, k) == ("one", 1):
                for y, x, kind in ((10, 20, 0), (90, 120, 0), (20, 120, 1)):
                    page[y : y + 40, x : x + 40] = mark(kind)
            (tmp_path / "pages" / book / f"page_{k:04d}.png").write_bytes(png(page))
    return str(tmp_path / "pages")


@pytest.fixture
def glyphs(spark, tmp_path):
    rows = [(0x41, "a", 40, 40, bytearray(mark(0).tobytes())), (0x42, "b", 40, 40, bytearray(mark(1).tobytes())), (0x43, "a2", 40, 40, bytearray(mark(0).tobytes())), (0x44, "blank", 9, 9, bytearray(paper(9, 9).tobytes())), (0x10, "low", 40, 40, bytearray(mark(0).tobytes()))]
    spark.createDataFrame(rows, schemas.GLYPH).write.parquet(str(tmp_path / "glyphs"))
    return str(tmp_path / "glyphs")


@pytest.fixture
def symbol_map(tmp_path):
    symbols = [{"icon": "Alpha", "group": "neume", "role": "base", "insert": "A", "variants": {"insert": "A"}}, {"icon": "Beta", "group": "gorgon", "role": "modifier", "insert": "B", "variants": {"insert": "B"}}, {"icon": "None", "group": "rest", "role": "rest", "insert": None, "variants": {}}]
    (tmp_path / "map.json").write_text(json.dumps({"_meta": {}, "symbols": symbols}))
    return str(tmp_path / "map.json")


def test_page_images(spark, pages):
    got = files.page_images(spark, [pages]).orderBy("page").collect()
    assert [(r.book_id, r.page_number, r.width, r.height, r.channels) for r in got] == [("Holy Week", 1, 200, 150, 1), ("one", 1, 200, 150, 1), ("one", 2, 200, 150, 1)]
    assert [r.page_number for r in files.page_images(spark, [pages], ["one"], head=1).collect()] == [1]


def test_groups_templates_and_matches(spark, pages, glyphs, tmp_path):
    from inkmill.operators import shapes

    table = files.read_glyphs(spark, glyphs)
    found = matching.glyph_shapes(table)
    assert sorted(r.key for r in found.collect()) == ["U+0041", "U+0042", "U+0043"]
    groups = shapes.shape_groups(found, 0.9)
    assert [list(r.members) for r in groups.orderBy("id").collect()] == [[0x41, 0x43], [0x42]]
    labels = groups.select(F.col("id").alias("label"), F.explode(F.col("members").cast("array<int>")).alias("cp"))
    made = matching.templates(table, labels, [96.0])
    assert sorted((r.label, r.cp) for r in made.collect()) == [("shape_0001", 0x41), ("shape_0002", 0x42)]
    images = files.page_images(spark, [pages])
    hits = matching.match_groups(images, made, {"shape_0001": (0.8, 10)}, 0.8)
    assert sorted((r.label, r.x, r.y) for r in hits.collect()) == [("shape_0001", 20, 10), ("shape_0001", 120, 90), ("shape_0002", 120, 20)]
    assert matching.match_groups(images, made, {"shape_0001": (1.1, 10)}, 1.1).count() == 0
    by_score = matching.match_cascade(images, made, 0.9, score_only=True)
    assert sorted((r.x, r.y) for r in by_score.collect()) == [(20, 10), (120, 20), (120, 90)]
    known = table.where("cp >= 65").select(F.format_string("shape_%04d", F.col("cp") - 64).alias("label"), "cp")
    freq = matching.frequency_table(matching.page_counts(hits), known, 3)
    assert [(r.label, r.n, r.per_page, r.pct, r["rank"]) for r in freq.orderBy("rank").collect()] == [("shape_0001", 2, 0.667, 66.667, 1), ("shape_0002", 1, 0.333, 33.333, 2), ("shape_0003", 0, 0.0, 0.0, 3), ("shape_0004", 0, 0.0, 0.0, 4)]
    sinks.write_detections(hits, groups, str(tmp_path / "flat"))
    flat = spark.read.option("header", "true").csv(str(tmp_path / "flat"))
    assert flat.columns == ["page", "group_id", "representative", "x", "y", "width", "height", "score", "size_pt", "members"]
    assert {r.members for r in flat.collect()} == {"U+0041 U+0043", "U+0042"}
    page, console = sinks.frequency_report(freq)
    assert "Not found" in page and console.count("\n") == 3
    names = spark.createDataFrame([("shape_0001", ["Alpha", "Alpha"])], "id string, icons array<string>")
    report = sinks.match_report(groups, hits.groupBy("label").agg(F.count("*").alias("n")), names)
    assert '<span class="count">1</span>' in report and report.index("shape_0001") < report.index("shape_0002") and "Alpha</td>" in report
    assert "U+0042" in sinks.family_report(groups, shapes.similar_pairs(found, 0.0))


def test_manifest_round_trip(spark, tmp_path):
    path = str(tmp_path / "manifest")
    row = ("book", 1, "data/pages/book/page_0001.png", "abc", 400, 10, 10, False, "rtl", 0.5)
    sinks.write_manifest(spark, path, spark.createDataFrame([row], schemas.MANIFEST))
    sinks.write_manifest(spark, path, spark.createDataFrame([("book", 1, *row[2:3], "new", *row[4:]), ("book", 2, *row[2:])], schemas.MANIFEST))
    assert sorted((r.page_number, r.sha256, r.direction) for r in files.read_manifest(spark, path).collect()) == [(1, "new", "rtl"), (2, "abc", "rtl")]
    (tmp_path / "old.csv").write_text("book_id,page_number,image_path,sha256,dpi,width,height,masked\nbook,1,data/pages/book/page_0001.png,abc,400,10,10,False\n")
    r = files.read_manifest(spark, str(tmp_path / "old.csv")).first()
    assert (r.book_id, r.page_number, r.masked, r.direction, r.ink_ratio) == ("book", 1, False, "ltr", 1.0)
    assert files.frequency_pages(files.read_manifest(spark, path), 1, "42", "book").count() == 1


def test_render_hook(spark, tmp_path):
    (tmp_path / "pdf" / "deep").mkdir(parents=True)
    (tmp_path / "pdf" / "one.pdf").write_bytes(b"\x03")
    (tmp_path / "pdf" / "deep" / "two.pdf").write_bytes(b"\x03")
    pdfs = files.pdf_files(spark, [str(tmp_path / "pdf")])
    counts = files.page_counts(pdfs, lambda data: data[0])
    assert [(r.book_id, r.pages) for r in counts.collect()] == [("one", 3)]

    def rasterise(data, page, dpi):
        image = np.full((40, 100), 255, np.uint8)
        image[10:30, 70:95] = 0
        return image

    chunks = spark.createDataFrame([("one", 2, 3)], "book_id string, chunk_first int, chunk_last int")
    got = files.render_pages(pdfs, chunks, rasterise, str(tmp_path / "out"), files.directions(spark, {"one": {"default": "ltr"}}).where("false"), direction="auto")
    sinks.write_pages(got)
    rows = sorted(got.collect(), key=lambda r: r.page_number)
    assert [(r.page_number, r.direction, r.width, round(r.ink_ratio, 3)) for r in rows] == [(2, "rtl", 100, 0.125), (3, "rtl", 100, 0.125)]
    assert files.page_images(spark, [str(tmp_path / "out")]).count() == 2 and files.pdf_files(spark, []).count() == 0


@pytest.fixture
def engine(monkeypatch):
    """Drawing functions in a module that command lines can name; made here, so that they travel by value."""
    import sys
    import types

    def draw(data, page, dpi):
        image = np.full((40, 100), 255, np.uint8)
        image[10:30, 70:95] = 0
        return image

    def cmap(data):
        return {cp: f"g{cp}" for cp in (0x10, 0x20, *range(0x41, 0x41 + data[0]), 0x3000)}

    def glyph(data, cp, pixels):
        if cp in (0x20, 0x42):
            return None
        image = np.full((pixels, pixels // 2), 255, np.uint8)
        image[: pixels // 2, : 4 * (cp - 0x40)] = 0
        return image

    module = types.ModuleType("test_engine")
    module.draw, module.count, module.cmap, module.glyph = draw, lambda data: data[0], cmap, glyph
    monkeypatch.setitem(sys.modules, "test_engine", module)
    return module


def test_render_command(spark, tmp_path, engine):
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf" / "one.pdf").write_bytes(b"\x03")
    (tmp_path / "d.json").write_text(json.dumps({"one": {"page_0002": "rtl"}}))
    command = ["render", "--pdfs", str(tmp_path / "pdf"), "--renderer", "test_engine:draw", "--page-counter", "test_engine:count", "--root", str(tmp_path / "out"), "--manifest", str(tmp_path / "m"), "--directions", str(tmp_path / "d.json"), "--chunk", "2"]
    cli.main([*command, "--last", "2"])
    read = lambda: sorted((r.page_number, r.direction, r.dpi, r.width) for r in files.read_manifest(spark, str(tmp_path / "m")).collect())
    assert read() == [(1, "ltr", 400, 100), (2, "rtl", 400, 100)]
    cli.main([*command, "--dpi", "300"])  # only the page that is missing
    assert read() == [(1, "ltr", 400, 100), (2, "rtl", 400, 100), (3, "ltr", 300, 100)]
    cli.main([*command, "--dpi", "300", "--force"])
    assert {r[2] for r in read()} == {300} and files.page_images(spark, [str(tmp_path / "out")]).count() == 3


def test_font_glyphs(spark, tmp_path, engine):
    (tmp_path / "font.bin").write_bytes(b"\x03")
    cli.main(["glyphs", "--font", str(tmp_path / "font.bin"), "--cmap", "test_engine:cmap", "--renderer", "test_engine:glyph", "--pixels", "20", "--output", str(tmp_path / "g")])
    rows = files.read_glyphs(spark, str(tmp_path / "g")).orderBy("cp").collect()
    assert [(r.cp, r.glyph_name, r.width, r.height) for r in rows] == [(0x41, "g65", 10, 20), (0x43, "g67", 10, 20)]
    assert [int((np.frombuffer(r.data, np.uint8) == 0).sum()) for r in rows] == [10, 30]
    many = files.font_glyphs(spark.createDataFrame([(bytearray([200]),)], "content binary"), engine.cmap, lambda *a: np.zeros((8, 8), np.uint8), None, size=2)
    assert many.count() == 202  # without ranges all from U+0020 on
    assert files.font_glyphs(many.where("false").selectExpr("data as content"), engine.cmap, engine.glyph).count() == 0


def test_configuration_readers(spark, tmp_path, symbol_map):
    (tmp_path / "c.yaml").write_text("names: {1: b, 0: a}\n")
    (tmp_path / "l.yaml").write_text("names: [a, b]\n")
    assert [[r.name for r in files.read_class_names(spark, str(tmp_path / f)).orderBy("class_id").collect()] for f in ("c.yaml", "l.yaml")] == [["a", "b"], ["a", "b"]]
    (tmp_path / "al.yaml").write_text("families:\n- representative: 004f\n  members: [U+004C, '0x006c', U+004C]\n- representative: '0041'\n  members: ['U+0041']\n")
    assert [list(r["keys"]) for r in files.read_aliases(spark, str(tmp_path / "al.yaml")).collect()] == [[0x4F, 0x4C, 0x6C]]
    (tmp_path / "bad.yaml").write_text("families: [{members: [U+004C]}]\n")
    with pytest.raises(ValueError, match="representative"):
        files.read_aliases(spark, str(tmp_path / "bad.yaml"))
    (tmp_path / "d.json").write_text(json.dumps({"a": "RTL", "b": {"default": "rtl", "2": "ltr"}}))
    assert sorted(map(tuple, files.read_directions(spark, str(tmp_path / "d.json")).collect())) == [("a", "default", "rtl"), ("b", "2", "ltr"), ("b", "default", "rtl")]
    with pytest.raises(ValueError, match="ltr or rtl"):
        files.directions(spark, {"a": "auto"})
    assert [(r.pos, r.icon, r.insert) for r in files.read_symbol_map(spark, symbol_map).orderBy("pos").collect()] == [(0, "Alpha", "A"), (1, "Beta", "B"), (2, "None", None)]
    (tmp_path / "g" / "x").mkdir(parents=True)
    (tmp_path / "g" / "x" / "expected_composition.json").write_text(json.dumps({"segments": [{"composition": "AB"}]}))
    assert [r.segments[0].composition for r in files.gold_compositions(spark, str(tmp_path / "g")).collect()] == ["AB"]
    for folder, names in (("i1", ["X"]), ("i2", ["X", "Y"])):
        (tmp_path / folder).mkdir()
        for n in names:
            (tmp_path / folder / f"{n}.gif").write_bytes(b"GIF")
    icons = {r.icon: r.path.split("/")[-2] for r in files.icon_files(spark, [str(tmp_path / "i1"), str(tmp_path / "i2")]).collect()}
    assert icons == {"X": "i1", "Y": "i2"}
    assert [list(r["keys"]) for r in files.read_members(spark, {"U+0041": ["42", "0x43"]}).collect()] == [[0x41, 0x42, 0x43]]


def test_json_and_yaml_sinks(spark, tmp_path):
    from inkmill.operators.taxonomy import class_list

    symbols = spark.createDataFrame([(0, "neume", "Oligon"), (1, "rest", "R")], "pos int, group string, icon string")
    assert sinks.classes_yaml(class_list(symbols)) == {"names": ["base_neume.Oligon", "rest.R"], "groups": {"neume": ["base_neume.Oligon"], "rest": ["rest.R"]}}
    sheet = sinks.reference_sheet(class_list(symbols).select("class_id", "name"), spark.createDataFrame([("R", "u")], "icon string, url string"))
    assert sheet.index("base_neume") < sheet.index("rest") and '<img src="u">' in sheet
    tasks = spark.createDataFrame([("u", "b", 1, "rtl")], "image string, book_id string, page_number int, direction string")
    sinks.write_tasks(tasks, str(tmp_path / "t.json"))
    assert json.loads((tmp_path / "t.json").read_text()) == [{"data": {"image": "u", "book_id": "b", "page_number": 1, "direction": "rtl"}}]
    groups = spark.createDataFrame([("shape_0001", 0x41, [0x41, 0x43])], schemas.GROUP)
    names = spark.createDataFrame([(0x41, "a"), (0x43, "c")], "id long, glyph_name string")
    icons = spark.createDataFrame([(0x43, ["X"])], "key long, icons array<string>")
    r = sinks.groups_json(groups, names, icons).first()
    assert [(m.codepoint, m.glyphName, list(m.icons)) for m in r.members] == [("U+0041", "a", []), ("U+0043", "c", ["X"])] and r.representative == "U+0041"
    with pytest.raises(ValueError, match="more than"):
        sinks.rows_of(spark.range(sinks.MAX_ROWS + 1))


def test_streaming_manifest(spark, tmp_path):
    rows = [("b", 1, "p", "a", 1, 1, 1, False, "ltr", 0.1), ("b", 1, "p", "z", 1, 1, 1, False, "ltr", 0.2)]
    spark.createDataFrame(rows, schemas.MANIFEST).write.mode("append").parquet(str(tmp_path / "in"))
    for expect, more in ((1, ("b", 2, "p", "c", 1, 1, 1, True, "ltr", 0.3)), (2, ("b", 1, "p", "q", 1, 1, 1, True, "ltr", 0.4))):
        keep_manifest(page_stream(spark, str(tmp_path / "in")), str(tmp_path / "m"), str(tmp_path / "cp")).awaitTermination()
        assert files.read_manifest(spark, str(tmp_path / "m")).count() == expect
        spark.createDataFrame([more], schemas.MANIFEST).write.mode("append").parquet(str(tmp_path / "in"))
    keep_manifest(page_stream(spark, str(tmp_path / "in")), str(tmp_path / "m"), str(tmp_path / "cp")).awaitTermination()
    assert {(r.page_number, r.sha256) for r in files.read_manifest(spark, str(tmp_path / "m")).collect()} == {(1, "q"), (2, "c")}
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    assert windowed_counts(events, "ts", "event_type", "1 day").agg(F.sum("n")).first()[0] == events.count()


def test_command_lines(spark, pages, glyphs, symbol_map, tmp_path, capsys):
    out = str(tmp_path / "o")
    (tmp_path / "classes.yaml").write_text("names: [base_neume.Alpha, modifier_gorgon.Beta]\n")
    classes = str(tmp_path / "classes.yaml")
    cli.main(["segment", "--pages", pages, "--output", f"{out}/layout.json", "--html", f"{out}/layout.html"])
    assert len(json.loads((tmp_path / "o" / "layout.json").read_text())["pages"]) == 3
    cli.main(["match", "--glyphs", glyphs, "--symbol-map", symbol_map, "--pages", pages, "--size", "96", "--threshold", "0.8", "--output", out])
    found = json.loads((tmp_path / "o" / "matches.json").read_text())["pages"]
    assert sorted((d["x"], d["y"]) for p in found for d in p["detections"]) == [(20, 10), (120, 20), (120, 90)]
    assert [m["icons"] for m in json.loads((tmp_path / "o" / "groups.json").read_text())["groups"][0]["members"]] == [["Alpha"], []]
    cli.main(["families", "--glyphs", glyphs, "--threshold", "0.8", "--heat-map", "--output", out])
    cli.main(["propose", "--glyphs", glyphs, "--symbol-map", symbol_map, "--min-similarity", "-1", "--output", f"{out}/p.yaml"])
    cli.main(["config", "--classes", classes, "--output", f"{out}/c.xml"])
    cli.main(["autolabel", "--glyphs", glyphs, "--symbol-map", symbol_map, "--pages", pages, "--root", "/x", "--size", "96", "--threshold", "0.9", "--output", f"{out}/pred.json"])
    assert sorted(len(p["result"]) for p in json.loads((tmp_path / "o" / "pred.json").read_text())) == [0, 0, 3]
    cli.main(["sync", "--symbol-map", symbol_map, "--classes", f"{out}/cl.yaml"])
    cli.main(["sync", "--symbol-map", symbol_map, "--classes", f"{out}/cl.yaml", "--check"])
    with pytest.raises(SystemExit):
        cli.main(["sync", "--symbol-map", symbol_map, "--classes", classes, "--check"])
    (tmp_path / "audit.csv").write_text("image_path,expected\ndata/one/page_0001.png,content\ndata/one/page_0002.png,blank\n")
    cli.main(["audit", "--audit", str(tmp_path / "audit.csv"), "--pages", pages, "--output", f"{out}/audit"])
    assert "precision 1.000" in capsys.readouterr().out
    rows = [("one", k, f"{pages}/one/page_{k:04d}.png", "s", 1, 1, 1, False, "ltr", 0.5) for k in (1, 2)]
    sinks.write_manifest(spark, f"{out}/m", spark.createDataFrame(rows, schemas.MANIFEST))
    cli.main(["plan", "--book", "one", "--pages", "1-5", "--manifest", f"{out}/m"])
    cli.main(["tasks", "--manifest", f"{out}/m", "--root", str(tmp_path), "--output", f"{out}/tasks.json"])
    assert len(json.loads((tmp_path / "o" / "tasks.json").read_text())) == 2
    cli.main(["frequencies", "--manifest", f"{out}/m", "--glyphs", glyphs, "--pages", pages, "--all", "--size", "96", "--threshold", "0.9", "--output", out])
    (tmp_path / "families.json").write_text(json.dumps([{"id": "f", "representative": "U+0041", "codepoints": ["U+0041", "U+0043"], "icons": []}]))
    cli.main(["frequencies", "--manifest", f"{out}/m", "--glyphs", glyphs, "--pages", pages, "--all", "--size", "96", "--threshold", "0.9", "--no-gradient", "--families", str(tmp_path / "families.json"), "--output", out])
    counted = {r.label: int(r.n) for r in spark.read.option("header", "true").csv(f"{out}/frequencies").collect()}
    assert counted["U+0041"] == 2 and counted["U+0042"] == 1 and "U+0043" not in counted
    cli.main(["sheet", "--classes", classes, "--icons", str(tmp_path), "--output", f"{out}/sheet.html"])
    assert cli._families("U+41,0x42") == (0x41, 0x42)
    assert stats.precision(spark.read.option("header", "true").csv(f"{out}/audit").withColumn("passed", F.col("passed").cast("boolean")), "passed").first().precision == 1


def test_gold_gate(spark, symbol_map, tmp_path):
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "expected_composition.json").write_text(json.dumps({"segments": [{"composition": "AB"}]}))
    cli.main(["gold", "--gold", str(tmp_path / "g"), "--symbol-map", symbol_map, "--least", "1"])
    with pytest.raises(SystemExit):
        cli.main(["gold", "--gold", str(tmp_path / "g"), "--symbol-map", symbol_map, "--least", "2"])
