import random

import pytest

from inkmill.operators.suppress import cascade_order, complex_order, priority_order, suppress, suppress_by_rounds

SCHEMA = "page string, ord int, x int, y int, w int, h int, score double, name string, priority int, area int"


def table(spark, rows):
    return spark.createDataFrame([("p", k, *r, r[2] * r[3]) for k, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("method", [suppress, suppress_by_rounds])
@pytest.mark.parametrize(
    ("rows", "order", "threshold", "kept"),
    [
        # two marks on one spot: the surer stays, and so does one elsewhere
        ([(40, 7, 12, 30, 0.61, "faint", 3), (42, 9, 12, 30, 0.64, "clear", 3), (200, 150, 12, 30, 0.62, "far", 3)], lambda: priority_order(), 0.5, ["clear", "far"]),
        # a part within a larger sign: the larger goes first unless the score alone decides
        ([(60, 60, 16, 16, 0.9, "part", 3), (55, 55, 30, 30, 0.5, "sign", 3)], lambda: complex_order(), 0.25, ["sign"]),
        ([(60, 60, 16, 16, 0.9, "part", 3), (55, 55, 30, 30, 0.5, "sign", 3)], lambda: cascade_order(), 0.25, ["sign"]),
        ([(60, 60, 16, 16, 0.9, "part", 3), (55, 55, 30, 30, 0.5, "sign", 3)], lambda: cascade_order(score_only=True), 0.25, ["part"]),
        # protected groups stand before area and score
        ([(5, 5, 50, 40, 0.55, "named", 60), (4, 4, 52, 42, 0.85, "plain", 20)], lambda: complex_order(), 0.6, ["named"]),
    ],
)
def test_examples(spark, method, rows, order, threshold, kept):
    got = method(table(spark, rows), ["page"], order(), ["ord"], threshold).collect()
    assert sorted(r.name for r in got) == sorted(kept)


def slow_iou(a, b):
    w = max(0, min(a[2] + a[4], b[2] + b[4]) - max(a[2], b[2]))
    h = max(0, min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3]))
    union = a[4] * a[5] + b[4] * b[5] - w * h
    return w * h / union if union else 0


def test_both_methods_are_greedy(spark):
    rng = random.Random(2)
    rows = [(f"p{rng.randrange(5)}", k, rng.randrange(60), rng.randrange(60), rng.choice([0, 8, 20]), rng.choice([8, 20]), round(rng.random(), 1), "n", rng.choice([10, 50]), 0) for k in range(300)]
    want = set()
    for page in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == page), key=lambda r: (r[8] < 50, -r[4] * r[5], -r[8], -r[6], r[1])):
            if all(slow_iou(r, k) < 0.3 for k in kept):
                kept.append(r)
        want |= {(page, k[1]) for k in kept}
    boxes = spark.createDataFrame(rows, SCHEMA)
    for method in (suppress, suppress_by_rounds):
        assert {(r.page, r.ord) for r in method(boxes, ["page"], complex_order(), ["ord"], 0.3).collect()} == want
        assert method(boxes.limit(0), ["page"], complex_order(), ["ord"], 0.3).collect() == []
