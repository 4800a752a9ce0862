"""Manifests, islands, folds, statistics and taxonomy over small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.operators import folds, islands, manifest, reading, stats, taxonomy

PAGES = "book_id string, page_number int"


@pytest.mark.parametrize("block", [1, 3, 65536])
def test_runs_against_a_loop(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice("ab"), rng.randint(-20, 40)) for _ in range(70)] + [("a", None)]
    want = []
    for key in "ab":
        numbers = sorted({n for k, n in rows if k == key and n is not None})
        for n in numbers:
            if want and want[-1][0] == key and want[-1][2] == n - 1:
                want[-1] = (key, want[-1][1], n)
            else:
                want.append((key, n, n))
    got = islands.contiguous_runs(spark.createDataFrame(rows, "k string, n int"), "n", ["k"], block)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert islands.contiguous_runs(spark.createDataFrame([], "n int"), "n", block=block).collect() == []


def test_chunks_and_plan(spark):
    planned = spark.createDataFrame([("b", n) for n in (1, 2, 3, 4, 8, 9)], PAGES)
    done = spark.createDataFrame([("c", 1)], PAGES)
    assert sorted(map(tuple, manifest.plan_chunks(planned, done, "book_id", "page_number", 3).collect())) == [("b", 1, 3), ("b", 4, 4), ("b", 8, 9)]
    done = spark.createDataFrame([("b", 2), ("", 3), (None, 4), ("b", 9)], PAGES)
    assert sorted(map(tuple, manifest.plan_chunks(planned, done, "book_id", "page_number", 3).collect())) == [("b", 1, 1), ("b", 3, 4), ("b", 8, 8)]
    with pytest.raises(ValueError, match="at least one"):
        islands.chunk_runs(planned, 0)


def test_upsert_keeps_repeats_of_new_rows(spark):
    old = spark.createDataFrame([("b", 1, "x"), ("b", 2, "x")], PAGES + ", v string")
    new = spark.createDataFrame([("b", 2, "y"), ("b", 2, "z"), ("b", 3, "y")], PAGES + ", v string")
    assert sorted(map(tuple, manifest.upsert(old, new, ["book_id", "page_number"]).collect())) == [("b", 1, "x"), ("b", 2, "y"), ("b", 2, "z"), ("b", 3, "y")]


def test_task_rows(spark):
    pages = spark.createDataFrame([("p1", "b", 1, "rtl", 0.1), ("p2", "b", 2, None, 0.0), ("p3", "b", 3, None, None)], "image_path string, book_id string, page_number int, direction string, ink_ratio double")
    assert [tuple(r) for r in manifest.task_rows(pages, F.col("image_path")).collect()] == [("p1", "b", 1, "rtl"), ("p3", "b", 3, "ltr")]
    assert manifest.task_rows(pages, F.col("image_path"), skip_blank=False, limit=2).count() == 2


def test_bands_and_maxima(spark):
    rows = spark.createDataFrame([(k, a) for k, a in enumerate([1, 1, 0, 1, 0, 1, 1, 1])], "k int, a int")
    assert sorted(map(tuple, islands.active_bands(rows, "k", F.col("a") == 1, min_length=2).collect())) == [(0, 2), (5, 8)]
    series = spark.createDataFrame([("s", k, v) for k, v in enumerate([1, 3, 3, 2, 5, 1])], "s string, k int, v int")
    assert sorted(r.k for r in islands.local_maxima(series, ["s"], "k", "v", 1).collect()) == [1, 2, 4]


@pytest.mark.parametrize("seed", range(3))
def test_row_groups_against_all_groups(spark, seed):
    """The first of all groups within the tolerance, not only the last: the same result on sorted input."""
    rng = np.random.default_rng(seed)
    rows = [(int(p), k, float(y)) for k, (p, y) in enumerate(zip(rng.integers(0, 4, 200), rng.integers(0, 300, 200), strict=True))]
    want = {}
    for page in range(4):
        groups = []
        for _, k, y in sorted((r for r in rows if r[0] == page), key=lambda r: (r[2], r[1])):
            for n, g in enumerate(groups):
                if abs(y - sum(g) / len(g)) <= 6:
                    g.append(y)
                    want[k] = n
                    break
            else:
                groups.append([y])
                want[k] = len(groups) - 1
    df = spark.createDataFrame(rows, "page int, k int, y double")
    assert {r.k: r.row_index for r in folds.row_groups(df, ["page"], "y", ["k"], 6.0).collect()} == want
    by_column = folds.row_groups(df.withColumn("t", F.lit(6.0)), ["page"], "y", ["k"], "t")
    assert {r.k: r.row_index for r in by_column.collect()} == want


def test_merge_overlapping_joins_the_first_match(spark):
    rows = [(0, 0, 10, 100, 20), (1, 0, 15, 100, 40), (2, 200, 12, 300, 60), (3, 0, 38, 320, 50), (4, 0, 90, 10, 95)]
    got = folds.merge_overlapping(spark.createDataFrame([(0, *r) for r in rows], "page int, id int, x1 int, y1 int, x2 int, y2 int"), ["page"], ["id"])
    assert {r.id: r.band_index for r in got.collect()} == {0: 0, 1: 0, 2: 1, 3: 0, 4: 2} or {r.id: r.band_index for r in got.collect()}[4] == 2


BOX = "page string, ord int, class_name string, x1 double, y1 double, x2 double, y2 double, width int"


def read(spark, boxes, width=None, **kw):
    rows = [("p", k, n, *map(float, xy), width or 0) for k, (n, *xy) in enumerate(boxes)]
    out = reading.reading_order(spark.createDataFrame(rows, BOX), ["page"], width="width" if width is not None else None, **kw)
    return [r.class_name for r in out.orderBy("place").collect()]


def test_reading_order(spark):
    assert read(spark, [("b", 90, 10, 100, 20), ("a", 10, 10, 20, 20), ("c", 40, 50, 50, 60)]) == ["a", "b", "c"]
    pair = [("left", 10, 10, 20, 20), ("right", 90, 10, 100, 20)]
    assert read(spark, pair, default="rtl") == ["right", "left"]
    four = [("top_left", 10, 10, 20, 20), ("top_right", 30, 10, 40, 20), ("bottom_left", 160, 50, 170, 60), ("bottom_right", 190, 50, 200, 60)]
    assert read(spark, four, 200) == ["top_left", "top_right", "bottom_right", "bottom_left"]
    assert read(spark, four, 0) == ["top_left", "top_right", "bottom_left", "bottom_right"]
    override = spark.createDataFrame([("p", 0, "rtl")], "page string, row_index int, override string")
    assert read(spark, pair, 200, overrides=override) == ["right", "left"]


def test_integrity(spark):
    symbols = spark.createDataFrame([("A", "neume", "1", {"insert": "1", "long": None}), ("B", "neume", "1", {"insert": "1"}), ("K", "key_signature", "1x", {"insert": "1x"}), ("L", "key_signature", "zq", None)], "icon string, group string, insert string, variants map<string,string>")
    actions = spark.createDataFrame([("A", ["z"]), ("Lost", None)], "icon string, chars array<string>")
    assert sorted(map(tuple, taxonomy.integrity(symbols, actions).collect())) == [("orphan", "Lost", ""), ("repeated", "A", "neume insert 1"), ("unknown insert", "L", "q")]


@pytest.mark.parametrize(("block_rows", "pair_limit"), [(1, -1), (7, -1), (50_000, -1), (50_000, 5_000_000), (5, 500)])
def test_nearest_against_a_loop(spark, block_rows, pair_limit):
    rng = random.Random(block_rows)
    rows = [(rng.choice("pqr"), k, rng.randint(0, 9), float(rng.randint(0, 9))) for k in range(80)]
    bases = [(rng.choice("pq"), k, rng.randint(0, 9), float(rng.randint(0, 9))) for k in range(40)]
    want = set()
    for page, k, x, y in rows:
        near = [(abs(x - a) + abs(y - b), j) for p, j, a, b in bases if p == page]
        if near:
            want.add((page, k, min(near)[1], min(near)[0]))
    left, right = spark.createDataFrame(rows, "page string, id int, x int, y double"), spark.createDataFrame(bases, "page string, base long, x int, y double")
    got = stats.nearest(left, right, ["page"], "id", "base", ["x", "y"], block_rows, pair_limit)
    assert set(map(tuple, got.collect())) == want and got.dtypes == [("page", "string"), ("id", "int"), ("base", "bigint"), ("distance", "double")]
    assert stats.nearest(left, right.limit(0), ["page"], "id", "base", ["x", "y"]).collect() == []


def test_fold_families(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 2), ("outside", 9)], "k string, n long")
    known = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    families = spark.createDataFrame([("b", "a", 0), ("c", "a", 1), ("c", "z", 2)], "member string, representative string, ord int")
    assert {r.family: r.n for r in stats.fold_families(counts, known, families, "k", "n").collect()} == {"a": 5, "z": 0, "d": 0}


def test_limits_sizes_and_members(spark):
    groups = spark.createDataFrame([("g1", "Oligon"), ("g1", "Other"), ("g2", "Nothing"), ("g3", "Apostrofos")], "group_id string, icon string")
    limits = spark.createDataFrame([("Apostrofos", 0.65, 35), ("Oligon", 0.78, 5), ("Other", 0.7, 20)], "icon string, threshold double, priority int")
    assert {r.group_id: (r.threshold, r.priority) for r in stats.group_limits(groups, limits, 0.75, 10).collect()} == {"g1": (0.7, 20), "g2": (0.75, 10), "g3": (0.65, 35)}
    variants = spark.createDataFrame([("a", ["Oligon"], 7.0), ("a", ["Oligon"], 9.0), ("b", ["X"], 7.0), ("b", ["X"], 9.0)], "group_id string, icons array<string>, pt double")
    assert sorted((r.group_id, r.pt) for r in stats.largest_sizes(variants, ["Oligon"]).collect()) == [("a", 9.0), ("b", 7.0), ("b", 9.0)]
    made = spark.createDataFrame([("a", 5, [5, 6], ["OnePlusOneUp"]), ("b", 7, [7, 8], [])], "id string, representative long, members array<long>, icons array<string>")
    assert [list(r.members) for r in stats.template_members(made, "OnePlusOneUp").orderBy("id").collect()] == [[5], [7, 8]]


def test_small_aggregates(spark):
    rows = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 3, False)], "k string, t int, ok boolean")
    assert {r.k: r.t for r in stats.latest_valid(rows, ["k"], "t", F.col("ok")).collect()} == {"a": 1, "b": 3}
    assert stats.precision(rows, "ok").first().precision == pytest.approx(1 / 3) and stats.precision(rows.limit(0), "ok").first().precision == 0
    assert {r.k: list(r.v) for r in stats.ordered_distinct(rows.withColumn("x", F.col("t") % 2), ["k"], F.col("t"), "x", "v").collect()} == {"a": [1, 0], "b": [1]}
    assert stats.seeded_sample(rows, "t", 2, "s").collect() == stats.seeded_sample(rows.repartition(3), "t", 2, "s").collect()
    assert stats.seeded_sample(rows, "t", 9, "s").count() == 3


def test_taxonomy(spark):
    bars = spark.createDataFrame([("neume", 0, "Oligon", {"insert": "1", "short": None}), ("neume", 1, "Siopi1", {"insert": "_"}), ("mode", 2, "Pa", {"long": "p"}), ("gorgon", 3, "G", {"insert": None})], "grp string, pos int, icon string, variants map<string,string>")
    keys = spark.createDataFrame([(0, "PaKey", "Pa key", "vV", 7, "midOnly", "c", 1)], "pos int, icon string, label string, insert string, key_id int, key_role string, category string, base_pitch int")
    actions = spark.createDataFrame([("Oligon", ["", "x", "y"]), ("Lost", ["z"])], "icon string, chars array<string>")
    got = taxonomy.build_symbols(bars, keys, actions).orderBy("pos").collect()
    assert [(r.icon, r.group, r.role, r.insert, r.key_role, r.chars) for r in got] == [("Oligon", "neume", "base", "1", None, "x"), ("Siopi1", "rest", "rest", "_", None, None), ("Pa", "mode", "key_signature", "p", "segmentStart", None), ("G", "gorgon", "modifier", None, None, None), ("PaKey", "key_signature", "key_signature", "vV", "midOnly", None)]
    symbols = taxonomy.build_symbols(bars, keys, actions)
    assert [(r.class_id, r.name) for r in taxonomy.class_list(symbols).orderBy("class_id").collect()] == [(0, "base_neume.Oligon"), (1, "rest.Siopi1"), (2, "mode.Pa"), (3, "modifier_gorgon.G"), (4, "key_signature.PaKey")]
    assert [r.icon for r in taxonomy.orphans(actions, symbols).collect()] == ["Lost"]
    twice = bars.select("icon", "grp").union(spark.createDataFrame([("Pa", "isson"), ("G", "mode")], "icon string, grp string"))
    assert [(r.icon, r.n) for r in taxonomy.misplaced(twice, spark.createDataFrame([("Pa",)], "icon string")).collect()] == [("G", 2)]
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (3, "z", 1)], "id int, v string, w int")
    b = spark.createDataFrame([(1, "x", None), (2, "y", None), (4, "z", 1)], "id int, v string, w int")
    assert {r.id: r.change for r in taxonomy.drift(a, b, ["id"]).collect()} == {2: "changed", 3: "removed", 4: "added"}
