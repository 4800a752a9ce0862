import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.operators.layout import layout_mask, layout_metrics, pair_texts, segment


class Page:
    """A blank page that rows are drawn on."""

    def __init__(self, height=180, width=240):
        self.ink = np.full((height, width), 255, np.uint8)

    def box(self, y1, y2, x1, x2):
        self.ink[y1:y2, x1:x2] = 0
        return self

    def text(self, y):
        for k in range(6):
            self.box(y, y + 12, 30 + 14 * k, 35 + 14 * k)
        return self

    def chant(self, y):
        for k in range(4):
            self.box(y, y + 4, 28 + 45 * k, 60 + 45 * k)
        for k in range(3):
            self.box(y - 10, y - 4, 36 + 48 * k, 43 + 48 * k)
        return self

    def longtext(self, y):
        self.box(y, y + 4, 40, 100).box(y + 16, y + 20, 120, 185)
        for x in (60, 90, 145, 175):
            self.box(y - 12, y + 8, x, x + 5)
        return self


PAGES = {
    "pairs": Page().text(20).chant(62).text(88).chant(122).text(148),
    "above": Page().text(48).chant(92),
    "mask": Page().chant(62).text(88),
    "alone": Page().chant(62),
    "marks": Page().box(70, 74, 30, 85).box(70, 74, 100, 155).box(70, 74, 170, 225).box(54, 59, 80, 90).box(80, 86, 135, 150).text(106),
    "long": Page().longtext(70),
    "parts": Page().chant(62).box(92, 104, 30, 95).box(96, 110, 115, 170).box(112, 118, 45, 160),
    "far": Page(500).chant(62).text(92).text(420),
    "longbelow": Page().chant(62).longtext(98),
    "fragments": Page().chant(62).box(82, 88, 40, 195).box(94, 106, 55, 65).box(94, 106, 170, 180),
    "double": Page().box(54, 58, 30, 115).box(54, 58, 130, 220).box(82, 86, 50, 135).box(82, 86, 150, 225).text(112),
    "blank": Page(),
}


def images(spark, pages):
    rows = [(name, p.ink.shape[1], p.ink.shape[0], 1, bytearray(p.ink.tobytes())) for name, p in pages.items()]
    return spark.createDataFrame(rows, "page string, width int, height int, channels int, data binary")


@pytest.fixture(scope="module")
def layouts(spark):
    return {r.page: r for r in segment(images(spark, PAGES)).collect()}


def test_every_page_has_a_layout(layouts):
    assert set(layouts) == set(PAGES)
    assert layouts["blank"].chant_rows == layouts["blank"].non_score_regions == layouts["blank"].unpaired_lyric_rows == []


def test_pairs_texts_with_the_row_above(layouts):
    r = layouts["pairs"]
    assert [[t.bbox[1] for t in c.lyric_rows] for c in r.chant_rows] == [[88], [148]]
    assert [t.bbox[1] for t in r.non_score_regions] == [20] and r.unpaired_lyric_rows == []
    assert [c["index"] for c in r.chant_rows] == [0, 1]


def test_text_above_the_first_row_is_no_lyric(layouts):
    r = layouts["above"]
    assert len(r.chant_rows) == 1 and r.chant_rows[0].lyric_rows == [] and r.non_score_regions[0].bbox[1] == 48


def test_layout_mask(layouts):
    mask = layout_mask(layouts["mask"], 2)
    assert mask[62, 40] == 255 and mask[90, 40] == 0


def test_direction(spark, layouts):
    assert layouts["alone"].notation_direction == "ltr"
    r = segment(images(spark, {"alone": PAGES["alone"]}), "rtl").first()
    assert r.notation_direction == "rtl" and r.chant_rows[0].notation_direction == "rtl"


def test_marks_join_their_row(layouts):
    r = layouts["marks"]
    assert len(r.chant_rows) == 1 and r.chant_rows[0].bbox[1] <= 54 and r.chant_rows[0].bbox[3] >= 86
    assert len(r.chant_rows[0].lyric_rows) == 1 and r.unpaired_lyric_rows == []


def test_long_strokes_alone_are_no_row(layouts):
    assert layouts["long"].chant_rows == [] and len(layouts["long"].non_score_regions) == 1


def test_fragments_merge(layouts):
    assert [t.bbox for t in layouts["parts"].chant_rows[0].lyric_rows] == [[30, 92, 170, 118]]


def test_far_text_is_not_paired(layouts):
    r = layouts["far"]
    assert [t.bbox[1] for t in r.chant_rows[0].lyric_rows] == [92] and [t.bbox[1] for t in r.non_score_regions] == [420] and r.unpaired_lyric_rows == []


def test_long_strokes_below_a_row_are_its_text(layouts):
    assert [t.bbox[1] for t in layouts["longbelow"].chant_rows[0].lyric_rows] == [86]


def test_small_lower_fragments_go(layouts):
    assert [t.bbox[1] for t in layouts["fragments"].chant_rows[0].lyric_rows] == [82]


def test_double_rows_merge(layouts):
    r = layouts["double"]
    assert len(r.chant_rows) == 1 and r.chant_rows[0].bbox[1] <= 54 and r.chant_rows[0].bbox[3] >= 106 and len(r.chant_rows[0].lyric_rows) == 1


def test_metrics(spark, layouts):
    got = {r.page: (r.rows, r.lyrics, r.unpaired) for r in layout_metrics(segment(images(spark, {k: PAGES[k] for k in ("pairs", "blank")}))).collect()}
    assert got == {"pairs": (2, 2, 0), "blank": (0, 0, 0)}


def test_routes(spark):
    rows = spark.createDataFrame([("p", 0, 50, 60), ("p", 1, 100, 110)], "page string, r int, y1 int, y2 int")
    texts = spark.createDataFrame([("p", 0, 10, 20), ("p", 1, 70, 80), ("p", 2, 105, 160), ("p", 3, 400, 410), ("q", 4, 5, 9)], "page string, t int, y1 int, y2 int")
    got = sorted((r.t, r.r, r.route) for r in pair_texts(rows, texts, ["page"], "r", "t", F.lit(125), F.lit(500)).collect())
    assert got == [(0, None, "non_score"), (1, 0, "lyrics"), (2, 1, "lyrics"), (3, None, "non_score"), (4, None, "non_score")]
    nested = spark.createDataFrame([("p", 0, 0, 100), ("p", 1, 10, 20)], "page string, r int, y1 int, y2 int")
    low = spark.createDataFrame([("p", 0, 110, 140)], "page string, t int, y1 int, y2 int")
    assert pair_texts(nested.where("r = 0").union(nested.where("r = 1")), low, ["page"], "r", "t", F.lit(50), F.lit(500)).collect()[0].route == "unpaired"
