import random

import numpy as np
import pytest
import xxhash

from inkmill.llm.simhash import fingerprint, near_edges, shingle_hashes, similar_groups, simhash_groups, within_ring
from inkmill.operators.graph import connected_components


def slow_fingerprint(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    runs = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    value = sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def slow_groups(fps, distance):
    root = {i: i for i in fps}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in fps:
        for b in fps:
            if ((fps[a] ^ fps[b]) & (2**64 - 1)).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in fps}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "Ä a\x0bB  c\r\nd", " x y z", "w " * 70000, "é" * 50000])
def test_fingerprint_is_the_definition(text):
    assert fingerprint(text) == slow_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c')").first()[0] == fingerprint("a b c")


@pytest.mark.parametrize("pair_limit", [0, 1, 8, 1000])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_groups_match_all_pairs(spark, pair_limit, distance):
    rng = random.Random(distance)
    values = set()
    for _ in range(25):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 12])):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            values.add(x - (1 << 64) if x >> 63 else x)
    fps = {i: x for i, x in enumerate(sorted(values))}
    table = spark.createDataFrame([(x, i) for i, x in fps.items()], "fp long, rep long")
    got = {r.node: r.component for r in connected_components(near_edges(table, distance, pair_limit)).collect()}
    assert {i: got.get(i, i) for i in fps} == slow_groups(fps, distance)


def test_rows_nulls_ties_and_extra_columns(spark):
    rows = [(3, "a b c d", 0), (1, "a b c d", 1), (1, "a b c d", 2), (5, None, 3), (4, "", 4), (None, "a b c d", 5), (None, "only a null id", 6), (9, "x " * 40000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = sorted((r.id is None, r.id, r.component_id) for r in simhash_groups(docs).collect() if r.id is not None)
    assert got == [(False, 1, 1), (False, 1, 1), (False, 3, 1), (False, 4, 4), (False, 5, 4), (False, 9, 9)]
    assert sorted(str(r.component_id) for r in simhash_groups(docs).collect() if r.id is None) == ["1", "None"]
    assert simhash_groups(docs.limit(0)).collect() == []


def test_query_matches_all_pairs(spark, sf):
    from inkmill.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    got = QUERIES["op1_simhash"](spark, sf).collect()
    assert {r.doc_id: r.component_id for r in got} == slow_groups(fps, 2)
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{x & (2**64 - 1):016x}" for i, x in fps.items()}


def jaccards(docs, width=5):
    """Exact similarity of every pair that shares a shingle; docs: id -> row with text."""
    sets = {i: set(shingle_hashes(r.text, width).tolist()) or {0} for i, r in docs.items()}
    holders = {}
    for i, x in sets.items():
        for h in x:
            holders.setdefault(h, []).append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    return {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in pairs}


def link(pairs):
    """Connected groups of pairs."""
    group = {}
    for a, b in pairs:
        joined = group.get(a, {a}) | group.get(b, {b})
        for i in joined:
            group[i] = joined
    return list({id(g): g for g in group.values()}.values())


def test_running_budgets_never_lose_a_pair():
    rng = np.random.default_rng(1)
    for distance in (2, 14, 24):
        x = np.zeros(4000, np.uint64)
        for _ in range(distance):
            x |= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
        assert within_ring(x, distance).all()
    noise = rng.integers(0, 2**63, 4000).astype(np.uint64)
    assert within_ring(noise, 14).mean() < 0.01


@pytest.mark.parametrize("block_rows", [5, 1024])
def test_similar_groups_against_exact_similarity(spark, block_rows):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.id: r.component_id for r in similar_groups(docs, block_rows=block_rows).collect()}
    pairs = jaccards({r.doc_id: r for r in docs.collect()})
    groups = link([p for p, j in pairs.items() if j >= 0.8])
    want = {i: i for i in got} | {i: min(g) for g in groups for i in g}
    assert len(groups) > 20 and got == want


@pytest.mark.parametrize("block_shingles", [500, 2_000_000])
def test_small_sets_and_large_groups(spark, block_shingles):
    """Sets of a few shingles, and a group of 60 near copies beside 60 texts that share a passage with it."""
    rng = np.random.default_rng(4)
    rows = [" ".join(f"s{k}x{i}" for i in range(9 + (k + j) % 2)) for k in range(30) for j in range(2)]
    base = [f"b{i}" for i in range(200)]
    for k in range(60):
        words = list(base)
        words[int(rng.integers(200))] = f"new{k}"
        rows += [" ".join(words), " ".join(base[:60] + [f"o{k}x{i}" for i in range(150)])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.id: r.component_id for r in similar_groups(docs, block_rows=16, block_shingles=block_shingles).collect()}
    groups = link([p for p, j in jaccards({r.doc_id: r for r in docs.collect()}).items() if j >= 0.8])
    assert got == {i: i for i in got} | {i: min(g) for g in groups for i in g}
    assert max(map(len, groups)) == 60


def test_similar_groups_edge_rows(spark):
    many = " ".join(f"w{i}" for i in range(300))
    rows = [(5, many, 0), (2, many + " tail", 0), (9, many, 0), (9, many, 0), (None, many, 0), (7, None, 0), (6, " ", 0), (3, "alone", 0), (4, "x " * 90000, 0), (None, "only null ids", 0), (None, "only null ids", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, anchors int")
    got = sorted(((str(r.id), r.component_id) for r in similar_groups(docs).collect()), key=lambda x: (x[0], x[1] is None))
    assert got == [("2", 2), ("3", 3), ("4", 4), ("5", 2), ("6", 6), ("7", 6), ("9", 2), ("9", 2), ("None", 2), ("None", None), ("None", None)]
    assert similar_groups(docs.limit(0)).collect() == []


def test_the_exact_similarity_decides(spark):
    rows, want = [], {}
    for k in range(240):
        tail = (25, 27)[k % 2]  # 200 of 250 shingles are shared, exactly 0.8; or 200 of 254
        for side in "ab":
            rows.append((len(rows), " ".join([f"c{k}x{i}" for i in range(204)] + [f"{side}{k}x{i}" for i in range(tail)])))
        want |= {2 * k: 2 * k, 2 * k + 1: 2 * k + k % 2}
    got = {r.id: r.component_id for r in similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: c for i, c in got.items() if c != want[i]} == {}


def test_repeated_lines_count_once(spark):
    rows = []
    for k in range(20):
        line, rest = " ".join(f"l{k}x{i}" for i in range(12)) + " ", " ".join(f"r{k}x{i}" for i in range(600))
        rows += [(2 * k, line * 2 + rest), (2 * k + 1, line * 300 + rest + " more")]
    got = {r.id: r.component_id for r in similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
