import json

import pytest

from inkmill.operators import annotate
from inkmill.sources import files, sinks

CLASSES = [(0, "base_neume.Oligon"), (1, "modifier_gorgon.Gorgon"), (2, "modifier_isson.Pa")]


def result(label, x=10.0, y=20.0, w=30.0, h=40.0, kind="rectanglelabels"):
    return {"type": kind, "value": {"x": x, "y": y, "width": w, "height": h, "rectanglelabels": [label] if label else []}}


@pytest.fixture
def tasks(spark, tmp_path):
    rows = [
        {"id": 1, "data": {"image": "a/p1.png"}, "annotations": [{"was_cancelled": False, "result": [result("base_neume.Oligon"), result("x", kind="choices")]}]},
        {"id": 2, "data": {"image": "a/p2.png"}, "annotations": [{"was_cancelled": False, "result": [result("modifier_isson.Pa")]}, {"was_cancelled": True, "result": [result("base_neume.Oligon")]}]},
        {"id": 3, "data": {"image": "a/p3.png"}, "annotations": [{"was_cancelled": True, "result": []}, {"was_cancelled": True, "result": [result("base_neume.Oligon", x=95.0, w=20.0)]}]},
        {"id": 4, "data": {"image": "a/p4.png"}, "annotations": []},
    ]
    (tmp_path / "tasks.json").write_text(json.dumps(rows))
    return files.read_tasks(spark, str(tmp_path / "tasks.json"))


def test_boxes_and_label_files(spark, tasks, tmp_path):
    classes = spark.createDataFrame(CLASSES, "class_id int, name string")
    lines = annotate.label_lines(annotate.boxes_from_tasks(tasks, classes, "data.image"))
    assert {r.image: r.lines for r in lines.collect()} == {"a/p1.png": "0 0.250000 0.400000 0.300000 0.400000", "a/p2.png": "2 0.250000 0.400000 0.300000 0.400000", "a/p3.png": "0 1.000000 0.400000 0.200000 0.400000"}
    sinks.write_label_files(lines, str(tmp_path / "labels"))
    back = spark.read.text(str(tmp_path / "labels"))
    assert sorted((r.stem, r.value) for r in back.collect())[0] == ("p1", "0 0.250000 0.400000 0.300000 0.400000")


def test_unknown_labels_raise(spark, tasks):
    with pytest.raises(Exception, match="unknown label"):
        annotate.boxes_from_tasks(tasks, spark.createDataFrame(CLASSES[:1], "class_id int, name string"), "data.image").collect()


@pytest.fixture
def labels(tmp_path):
    (tmp_path / "book" / "labels").mkdir(parents=True)
    (tmp_path / "book" / "labels" / "page_0001.txt").write_text("0 .20 .50 .10 .10\n\n1 .22 .40 .05 .05\n0   .80 .50 .10 .10\n2 .78 .35 .05 .05\n")
    return str(tmp_path / "book")


def test_statistics(spark, labels, tmp_path):
    boxes = annotate.parse_label_lines(files.label_lines(spark, labels), spark.createDataFrame(CLASSES, "class_id int, name string"))
    assert {(r.book_id, r.page_id) for r in boxes.collect()} == {("book", "page_0001")}
    tables = sinks.label_statistics(boxes)
    assert {r.class_name: (r["count"], r.percentage) for r in tables["frequency"].collect()} == {"base_neume.Oligon": (2, 0.5), "modifier_gorgon.Gorgon": (1, 0.25), "modifier_isson.Pa": (1, 0.25)}
    assert {tuple(r) for r in tables["cooccurrence"].select("base_icon", "modifier_icon", "count", "percentage").collect()} == {("Oligon", "Gorgon", 1, 0.5), ("Oligon", "Pa", 1, 0.5)}
    assert {r.group: r["count"] for r in tables["groups"].collect()} == {"base_neume": 2, "modifier_gorgon": 1, "modifier_isson": 1}
    sinks.write_statistics(boxes, str(tmp_path / "out"))
    assert [r.asDict() for r in spark.read.option("header", "true").csv(str(tmp_path / "out" / "frequency")).collect()][0]["count"] == "2"


@pytest.mark.parametrize(("line", "error"), [("0 1 2", "too few columns at .*page_0001.txt:2"), ("9 .1 .1 .1 .1", "unknown class at .*:2")])
def test_bad_label_lines_raise(spark, labels, line, error):
    with open(f"{labels}/labels/page_0001.txt", "w") as f:
        f.write("0 .1 .1 .1 .1\n" + line)
    with pytest.raises(Exception, match=error):
        annotate.parse_label_lines(files.label_lines(spark, labels), spark.createDataFrame(CLASSES, "class_id int, name string")).collect()


def test_label_config(spark):
    xml = sinks.label_config(spark.createDataFrame([(0, "a"), (11, "Dhi<Key"), (2, "it's \"&\"")], "class_id int, name string"))
    assert '<Label value="Dhi&lt;Key" background="#ff7f0e"/>' in xml and "it&#x27;s &quot;&amp;&quot;" in xml and xml.index('"a"') < xml.index("Dhi")


def test_predictions(spark):
    rows = [("p", "i", 100, 200, 0, "A", 10, 20, 30, 40, 0.81239), ("p", "i", 100, 200, 1, "B", 0, 0, 1, 1, 0.5), ("q", "j", 10, 10, None, None, None, None, None, None, None)]
    found = spark.createDataFrame(rows, "page string, image string, page_width int, page_height int, ord int, label string, x int, y int, w int, h int, score double")
    got = {r.page: r for r in annotate.predictions(found).collect()}
    v = got["p"].result[0].value
    assert (v.x, v.y, v.width, v.height, list(v.rectanglelabels)) == (10.0, 10.0, 30.0, 20.0, ["A"])
    assert got["p"].score == pytest.approx((0.8124 + 0.5) / 2) and got["q"].score == 0 and got["q"].result == []
