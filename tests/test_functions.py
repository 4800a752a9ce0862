import pytest
from pyspark.sql import functions as F

from inkmill.functions import boxes, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_page_path(spark):
    assert one(spark, text.page_path("data/pages", F.lit("book"), F.lit(12))) == "data/pages/book/page_0012.png"
    assert one(spark, text.page_path("r", F.lit("b"), F.lit(123456))) == "r/b/page_123456.png"


def test_page_ranges(spark):
    specs = spark.createDataFrame([("5-7,2,10-11",)], "spec string")
    assert sorted(r.page for r in text.parse_page_ranges(specs).collect()) == [2, 5, 6, 7, 10, 11]
    for bad in ("7-5", "0", "0-2"):
        with pytest.raises(Exception, match="bad page range"):
            text.parse_page_ranges(spark.createDataFrame([(bad,)], "spec string")).collect()
    assert text.parse_page_ranges(spark.createDataFrame([("",), (" ",), (None,)], "spec string")).collect() == []


def test_page_bounds(spark):
    rows = spark.createDataFrame([(None, None, 3), (2, 9, 4), (0, 0, 2), (5, 4, 9)], "a int, b int, n int")
    assert [r.p for r in rows.select(text.pages_from_bounds("a", "b", "n").alias("p")).collect()] == [[1, 2, 3], [2, 3, 4], [1, 2], []]


@pytest.mark.parametrize(("raw", "key"), [("004f", "U+004F"), ("U+004C", "U+004C"), ("0x006c", "U+006C"), ("1F600", "U+1F600"), (" u+e0d0 ", "U+E0D0")])
def test_codepoint_keys(spark, raw, key):
    assert one(spark, text.normal_key(F.lit(raw))) == key


def test_codepoint_ranges(spark):
    got = text.parse_ranges(spark.createDataFrame([("E0D0-E0D2",), ("U+0174",)], "spec string")).collect()
    assert [(r.lo, r.hi) for r in got] == [(0xE0D0, 0xE0D2), (0x174, 0x174)]
    with pytest.raises(Exception, match="descending"):
        text.parse_ranges(spark.createDataFrame([("12-11",)], "spec string")).collect()
    assert one(spark, text.in_ranges(F.lit(0x112))) and not one(spark, text.in_ranges(F.lit(0x111))) and one(spark, text.in_ranges(F.lit(5), ()))


def test_class_names(spark):
    rows = spark.createDataFrame([("base_neume.Oligon",), ("plain",), ("a.b.c",)], "n string")
    assert [tuple(r) for r in rows.select(text.class_group("n"), text.class_icon("n")).collect()] == [("base_neume", "Oligon"), ("plain", "plain"), ("a", "b.c")]
    names = spark.createDataFrame([("neume", "X"), ("gorgon", "Y"), ("rest", "Z")], "g string, i string")
    assert [r[0] for r in names.select(text.class_name("g", "i")).collect()] == ["base_neume.X", "modifier_gorgon.Y", "rest.Z"]


@pytest.mark.parametrize(("path", "book"), [("a/mybook/p.txt", "mybook"), ("d/mybook/labels/p.txt", "mybook"), ("x/labels/train/p.txt", "labels"), ("train/p.txt", "train")])
def test_book_of_label(spark, path, book):
    assert one(spark, text.book_of_label(F.lit(path))) == book


@pytest.mark.parametrize(
    ("url", "path"),
    [
        ("/data/local-files/?d=data/pages/book/page_0001.png", "root/data/pages/book/page_0001.png"),
        ("/data/local-files/?d=data/pages/Holy Week/page_0001.png", "root/data/pages/Holy Week/page_0001.png"),
        ("/data/local-files/?d=data/pages/Holy%20Week/page_0001.png", "root/data/pages/Holy Week/page_0001.png"),
        ("http://host/a/b+c.png?x=1", "root/b+c.png"),
        ("file:///tmp/a%20b.png", "/tmp/a b.png"),
        ("/abs/p.png", "/abs/p.png"),
        ("rel/p.png", "root/rel/p.png"),
    ],
)
def test_image_path(spark, url, path):
    assert one(spark, text.image_path(F.lit(url), "root")) == path


def test_local_file_url(spark):
    assert one(spark, text.local_file_url(F.lit("/r/data/Ä b.png"), "/r")) == "/data/local-files/?d=data/Ä b.png"
    assert one(spark, text.local_file_url(F.lit("/other.png"), "/r", strict=False)) == "/other.png"
    with pytest.raises(Exception, match="outside"):
        one(spark, text.local_file_url(F.lit("/other.png"), "/r"))


def test_directions(spark):
    assert one(spark, text.checked_direction(F.lit("RTL"))) == "rtl" and one(spark, text.checked_direction(F.lit("auto"))) == "auto"
    for bad in (F.lit("up"), F.lit(None).cast("string")):
        with pytest.raises(Exception, match="unknown direction"):
            one(spark, text.checked_direction(bad))
    with pytest.raises(Exception, match="unknown direction"):
        one(spark, text.checked_direction(F.lit("auto"), auto=False))
    pages = spark.createDataFrame([("book", 1), ("book", 2), ("other", 1)], "book_id string, page_number int")
    table = spark.createDataFrame([("book", "default", "rtl"), ("book", "2", "ltr")], "book string, key string, direction string")
    assert {(r.book_id, r.page_number): r.direction for r in text.resolve_direction(pages, table).collect()} == {("book", 1): "rtl", ("book", 2): "ltr", ("other", 1): "ltr"}


def test_blank_pages(spark):
    rows = spark.createDataFrame([("0",), ("0.0",), ("0.2",), ("",), (None,)], "r string")
    assert [r[0] for r in rows.select(text.is_blank_page("r")).collect()] == [True, True, False, False, False]


def test_assignments():
    assert text.parse_assignments(["A=0.5", "B = 1", "A=0.7"]) == {"A": 0.7, "B": 1.0}
    with pytest.raises(ValueError, match="assignment"):
        text.parse_assignments(["A"])


def test_box_expressions(spark):
    row = spark.createDataFrame([(10, 10, 20, 20, 11, 11, 20, 20)], "ax int, ay int, aw int, ah int, bx int, by int, bw int, bh int")
    assert abs(row.select(boxes.iou("a", "b")).first()[0] - 361 / 439) < 1e-12
    assert one(spark, boxes.pt_to_px(F.lit(8.25))) == 34 and one(spark, boxes.pt_to_px(F.lit(0.1))) == 4
    page = spark.createDataFrame([(5, 2, 90, 99)], "x1 int, y1 int, x2 int, y2 int")
    assert tuple(page.select(*boxes.padded(4, 8, F.lit(92), F.lit(100))).first()) == (1, 0, 92, 100)
    box = boxes.percent_to_centre(F.lit(10.0), F.lit(20.0), F.lit(30.0), F.lit(40.0))
    assert one(spark, boxes.yolo_line(F.lit(0), *box)) == "0 0.250000 0.400000 0.300000 0.400000"
    wide = boxes.percent_to_centre(F.lit(90.0), F.lit(-50.0), F.lit(130.0), F.lit(10.0))
    assert one(spark, boxes.yolo_line(F.lit(1), *wide)) == "1 1.000000 0.000000 1.000000 0.100000"


@pytest.mark.parametrize(("n", "long", "wide", "width", "want"), [(76, 10, 900, 500, False), (18, 3, 300, 500, True), (30, 9, 300, 200, False), (30, 10, 300, 500, True), (40, 3, 90, 299, True), (18, 5, 220, 500, True), (19, 5, 220, 500, False), (5, 2, 500, 100, False)])
def test_notation_rule(spark, n, long, wide, width, want):
    assert one(spark, boxes.is_notation(F.lit(n), F.lit(long), F.lit(wide), F.lit(width))) is want


def test_row_and_audit_rules(spark):
    assert one(spark, boxes.is_probable_row(F.lit(80), F.lit(8), F.lit(300))) and not one(spark, boxes.is_probable_row(F.lit(80), F.lit(3), F.lit(150))) and not one(spark, boxes.is_probable_row(F.lit(86), F.lit(9), F.lit(900)))
    rows = spark.createDataFrame([("content", 0.12), ("content", 0.0), ("blank", 0.0), ("blank", 0.5)], "e string, r double")
    assert [r[0] for r in rows.select(boxes.audit_passed("e", "r", 0.01, 0.001)).collect()] == [True, False, True, False]
    with pytest.raises(Exception, match="unknown expectation"):
        one(spark, boxes.audit_passed(F.lit("odd"), F.lit(0.1)))
