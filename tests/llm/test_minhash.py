import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.llm.minhash import OnePermutation, compare_with_next, fingerprints, in_order
from inkmill.llm.queries import QUERIES
from inkmill.llm.simhash import shingle_hashes


def jaccard(a, b, width=5):
    x, y = (set(shingle_hashes(t, width).tolist()) or {None} for t in (a, b))
    return len(x & y) / len(x | y)


def test_densification_probes_the_bins_own_sequence():
    scheme = OnePermutation(bin_bits=5, low_bits=4, width=2)
    text = "a b c d e"
    h = shingle_hashes(text, 2).tolist()
    least = {b: min(x for x in h if x >> 59 == b) for b in {x >> 59 for x in h}}
    got = scheme.minima(text).tolist()
    for b in range(32):
        targets = (t for chunk in range(50) for t in scheme._probe(chunk)[:, b].tolist())
        want = least[b] if b in least else least[next(t for t in targets if t in least)]
        assert got[b] == want


@pytest.mark.parametrize("low_bits", [1, 2, 4, 8])
def test_estimates_are_near_jaccard(low_bits):
    rng, scheme = random.Random(low_bits), OnePermutation(bin_bits=10, low_bits=low_bits, width=1)
    errors = []
    for k in range(60):
        n, shared = rng.choice([3, 40, 600, 5000]), rng.random()
        a = [f"w{i}" for i in range(n)]
        b = [f"w{i}" if i < shared * n else f"x{k}.{i}" for i in range(n)]
        a, b = " ".join(a), " ".join(b)
        errors.append(scheme.likeness(scheme.fingerprint(a), scheme.fingerprint(b)) - jaccard(a, b, 1))
    assert abs(np.mean(errors)) < 0.04 and np.mean(np.abs(errors)) < 0.08
    assert len(scheme.packed(scheme.fingerprint("a"))) == 1024 * low_bits // 8


def check(got, texts):
    """``texts``: (id, text) in the defined order."""
    scheme = OnePermutation()
    assert len(got) == len(texts)
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r)
    errors = []
    for k, (i, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        r = next(r for r in by[i] if r.edited_sha256 == sha and r.n_chars == len(text))
        by[i].remove(r)
        assert r.fingerprint == scheme.packed(scheme.fingerprint(text)).hex() and r.edited_fingerprint == scheme.packed(scheme.fingerprint(edited)).hex()
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, after)]
    return np.array(errors)


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    texts = [(r.doc_id, r.text) for r in sorted(docs, key=lambda r: -r.doc_id)]
    errors = check(QUERIES["op6_fingerprints"](spark, sf).collect(), texts)
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.2


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_edge_rows(spark, parts):
    rows = [(5, "b b", 0), (5, "a", 0), (None, "z", 0), (None, None, 0), (1, "", 0), (2, "long " * 30000, 0), (2, "long " * 30000, 0), (-7, "é😀 x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    hashed = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t, _ in rows], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    texts = sorted(((i, t or "") for i, t, _ in rows), key=lambda x: (x[0] is None, -(x[0] or 0), hashed[x[1]]))
    check(compare_with_next(docs, parts=parts).collect(), texts)
    check(compare_with_next(docs.where("doc_id = 1"), parts=parts).collect(), [(1, "")])
    assert compare_with_next(docs.limit(0), parts=parts).collect() == []
    fps = {r.id: bytes(r.fingerprint) for r in fingerprints(docs).collect()}
    assert fps[1] == bytes(OnePermutation().packed(OnePermutation().fingerprint(None)))


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_ids_that_many_rows_share_are_split(spark, parts):
    """A third of the rows has one id, a third none, a third one each; every row is once in the ring."""
    rows = [(700 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i} " * 3) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    hashed = {r.t: r.h for r in docs.select(F.col("text").alias("t"), F.xxhash64("text").alias("h")).collect()}
    texts = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), hashed[x[1]]))
    check(compare_with_next(docs, parts=parts).collect(), texts)
    sizes = [r["count"] for r in in_order(docs, "doc_id", "text", parts).groupBy(F.spark_partition_id()).count().collect()]
    assert parts == 1 or max(sizes) <= 3 * 1200 / parts + 2
