from zlib import crc32

import numpy as np

from inkmill.llm.queries import QUERIES
from inkmill.llm.toxicity import Settings, features, fit, platt, score, train


def slow_ftrl(rows, s, size):
    """The per-coordinate update written out for one coordinate at a time."""
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def w(i):
        l1 = 0 if i == size else s.l1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)

    for _ in range(s.epochs):
        for idx, y in rows:
            on = [*idx, size]
            now = {i: w(i) for i in on}
            g = 1 / (1 + np.exp(-sum(now.values()))) - y
            for i in on:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha
                z[i] += g - sigma * now[i]
                n[i] += g * g
    return w(size), {i: w(i) for i in range(size) if w(i)}


def test_train_is_ftrl():
    rng, s = np.random.default_rng(1), Settings(bits=6, l1=0.7, epochs=3)
    rows = [(np.sort(rng.choice(64, 9, replace=False)), int(rng.random() < 0.4)) for _ in range(80)]
    bias, idx, w = train(rows, s)
    slow_bias, slow = slow_ftrl(rows, s, 64)
    assert abs(bias - slow_bias) < 1e-9 and list(idx) == sorted(slow) and np.allclose(w, [slow[i] for i in idx])


def test_features_are_whole_text_sets():
    s = Settings()
    assert len(features(None, s)) == len(features(" .,\n", s)) == 0
    assert len(features("one", s)) == 2
    assert set(features("A b", s)) == set(features("a  B!", s)) != set(features("b a", s))
    assert set(features("tail", s)) <= set(features("x " * 300000 + "tail", s))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = QUERIES["op4_toxicity"](spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in got:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    yes, no = ([r for r in held if labels[r.doc_id] == y] for y in (1, 0))
    assert sum(r.predicted for r in yes) >= 0.85 * len(yes)
    assert sum(r.predicted for r in no) <= 0.01 * len(no)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "bad word", 9), (3, "bad word", 9), (3, "bad word", 9), (4, "nice " * 100000, 9)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, None), (4, 0), (None, 1), (9, 1), (2, 7)], "doc_id long, toxic int")
    got = {(r.id, round(r.score, 9)) for r in score(docs, fit(docs, labels)).collect()}
    assert len({s for i, s in got if i in (1, 2)}) == 1 and len({s for i, s in got if i == 3}) == 1
    assert {r.score < 1e-6 for r in score(docs, fit(docs, labels.limit(0))).collect()} == {True}
    assert score(docs.limit(0), fit(docs, labels)).collect() == []


def test_platt_finds_the_log_odds():
    rng = np.random.default_rng(2)
    raw = rng.normal(-2, 2, 20000)
    label = (rng.random(20000) < 1 / (1 + np.exp(-(2.5 * raw + 1)))).astype(int)
    scale, offset = platt(raw, label)
    assert abs(scale - 2.5) < 0.15 and abs(offset - 1) < 0.15
    assert platt(np.array([1.0] * 5 + [-1.0] * 5), np.array([1] * 5 + [0] * 5))[0] > 0.5
