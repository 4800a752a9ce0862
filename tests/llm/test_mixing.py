import random
import re
import time
from fractions import Fraction

import pytest

from inkmill.llm.mixing import MAX_PATTERNS, min_cost_flow, mix_documents, mix_words, water_fill, whole_quotas
from inkmill.llm.queries import QUERIES


def slow_targets(sizes, weights, limit):
    """Reshare by hand, one source over its limit at a time being enough to change nothing."""
    targets, frozen = {}, {s for s in sizes if not sizes[s]}
    left = Fraction(sum(sizes.values()))
    targets |= dict.fromkeys(frozen, Fraction(0))
    while True:
        live = [s for s in sizes if s not in frozen]
        share = {s: left * weights[s] / sum(weights[t] for t in live) for s in live}
        over = [s for s in live if share[s] > limit * sizes[s]]
        if not over:
            return targets | share
        for s in over:
            targets[s] = Fraction(limit * sizes[s])
            left -= targets[s]
            frozen.add(s)


def test_water_fill():
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 0, None: 300}
    weights = {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    got = water_fill(sizes, weights, 3)
    assert got == slow_targets(sizes, weights, 3)
    assert sum(got.values()) == sum(sizes.values()) == sum(whole_quotas(got).values())


def test_flow_repeats_only_where_it_must():
    flow = min_cost_flow({("a",): 10, ("a", "b"): 10, ("b",): 2}, {"a": 12, "b": 10}, 3)
    assert flow[("a",)]["a"] == 10 and flow[("a", "b")] == {"a": 2, "b": 8} and flow[("b",)]["b"] == 2
    flow = min_cost_flow({("a",): 4}, {"a": 11}, 3)
    assert flow[("a",)]["a"] == 11
    assert min_cost_flow({("a",): 4}, {"a": 100}, 3)[("a",)]["a"] == 12


def slow_flow(patterns, quotas, limit):
    """Least cost of the fullest routing, a word at a time by Bellman-Ford over single words' arcs."""
    nodes = ["s", "t", *patterns, *quotas]
    left, cost = {}, {}

    def arc(a, b, capacity, c):
        left[a, b, c], cost[a, b, c] = left.get((a, b, c), 0) + capacity, c
        left.setdefault((b, a, -c), 0)
        cost[b, a, -c] = -c

    for p, words in patterns.items():
        for k in range(limit):
            arc("s", p, words, k * k)
        for s in p:
            arc(p, s, limit * words, 0)
    for s, q in quotas.items():
        arc(s, "t", q, 0)
    words = total = 0
    while True:
        best, by = {n: float("inf") for n in nodes}, {}
        best["s"] = 0
        for _ in nodes:
            for (a, b, c), capacity in left.items():
                if capacity and best[a] + c < best[b]:
                    best[b], by[b] = best[a] + c, (a, b, c)
        if best["t"] == float("inf"):
            return words, total
        node = "t"
        while node != "s":
            a, b, c = by[node]
            left[a, b, c] -= 1
            left[b, a, -c] += 1
            node = a
        words, total = words + 1, total + best["t"]


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_full_and_cheapest(seed):
    rng = random.Random(seed)
    names = ["a", "b", "c"]
    patterns = {tuple(sorted(rng.sample(names, rng.randint(1, 3)))): rng.randint(0, 6) for _ in range(5)}
    quotas = {s: rng.randint(0, 12) for s in names}
    flow = min_cost_flow(patterns, quotas, 3)
    taken = {p: sum(f.values()) for p, f in flow.items()}
    assert all(taken[p] <= 3 * patterns[p] for p in patterns)
    assert all(sum(f.get(s, 0) for f in flow.values()) <= quotas[s] for s in names)
    cost = sum(sum(k * k * min(w, max(0, taken[p] - k * w)) for k in range(3)) for p, w in patterns.items())
    assert (sum(taken.values()), cost) == slow_flow(patterns, quotas, 3)


def test_flow_of_many_patterns_is_fast():
    rng = random.Random(1)
    names = [f"s{i}" for i in range(50)]
    patterns = {tuple(sorted(rng.sample(names, rng.randint(1, 4)))): rng.randint(1, 10**9) for _ in range(MAX_PATTERNS)}
    whole = sum(patterns.values())
    began = time.perf_counter()
    flow = min_cost_flow(patterns, {s: whole // 50 for s in names}, 3)
    assert sum(sum(f.values()) for f in flow.values()) == 50 * (whole // 50) and time.perf_counter() - began < 60


def test_documents_follow_the_words(spark, monkeypatch):
    """Every source's documents come to its target but for one document's half; with and without sending choices to the scan."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), "abc"[i % 3], i) for i in range(900)], "doc_id long, text string, source string, `a.b` int")
    found = []
    for limit in (0, 1000):
        monkeypatch.setattr("inkmill.llm.mixing.MAX_CHOSEN", limit)
        monkeypatch.setattr("inkmill.llm.mixing.BUCKET_BITS", 2)
        found.append(sorted(mix_documents(docs).collect()))
    assert found[0] == found[1] and mix_documents(docs).columns == docs.columns
    sizes = {s: sum(1 + i % 50 for i in range(900) if "abc"[i % 3] == s) for s in "abc"}
    want = slow_targets(sizes, {"a": 5, "b": 2, "c": 1}, 3)
    for s in "abc":
        assert abs(sum(1 + r.doc_id % 50 for r in found[0] if r.source == s) - want[s]) <= 25


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query(spark, folder):
    sf = f"/root/testdata/{folder}"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_mixing"](spark, sf).collect()
    again = QUERIES["op5_mixing"](spark, sf).collect()
    assert sorted(got) == sorted(again) and {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for i, r in docs.items()}
    by = {}
    for r in got:
        assert r["size"] == size[r.doc_id] and 0 <= r.taken <= 3 * r["size"]
        by.setdefault(docs[r.doc_id].source, []).append(r)
    names = sorted(by)
    sizes = {s: sum(r["size"] for r in by[s]) for s in names}
    want = slow_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 3)
    for s in names:
        assert {r.source_size for r in by[s]} == {sizes[s]} and {r.target for r in by[s]} == {float(want[s])}
        assert abs(sum(r.taken for r in by[s]) - want[s]) <= 1
        passes = {r.taken // r["size"] for r in by[s] if r["size"]}
        assert max(passes) - min(passes) <= 1


def test_edges_and_documents(spark):
    rows = [(1, "a b c", None, 1), (2, None, "x", 2), (3, "", "x", 3), (None, "w " * 50000, "x", 4), (4, "a b", "y", 5), (4, "a b", "y", 5), (5, "one", "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    got = mix_words(docs).collect()
    assert len(got) == 7 and sum(r.taken for r in got) == 50008
    assert {r["size"] for r in got if r.id in (2, 3)} == {0} and {r.taken for r in got if r.id in (2, 3)} == {0}
    kept = mix_documents(docs)
    assert kept.columns == docs.columns
    counts = {}
    for r in kept.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts[i] for i in counts if i not in (4,)) <= 3
    assert mix_words(docs.limit(0)).collect() == [] == mix_documents(docs.limit(0)).collect()


def test_overlapping_sources(spark):
    rows = [(i, "w " * (1 + i % 7), [["a"], ["b"], ["a", "b"], [], ["b", "a", "b"]][i % 5]) for i in range(400)]
    got = mix_words(spark.createDataFrame(rows, "doc_id long, text string, source array<string>")).collect()
    assert abs(sum(r.taken for r in got) - sum(r["size"] for r in got)) <= 3
    assert all(r.taken <= 3 * r["size"] for r in got)
