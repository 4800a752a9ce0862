import numpy as np
import pytest

from inkmill.llm.nndescent import near_embeddings
from inkmill.llm.queries import QUERIES


def brute(ids, vecs, threshold=0.9):
    x = np.array(vecs, np.float64)
    x = x / np.sqrt((x * x).sum(1))[:, None]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    root = list(range(len(ids)))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in zip(*np.nonzero(near), strict=True):
        p, q = find(a), find(b)
        root[max(p, q, key=lambda z: ids[z])] = min(p, q, key=lambda z: ids[z])
    return {i: (int(near[a].sum()), ids[find(a)]) for a, i in enumerate(ids)}


def beside(rng, v, cosine):
    u = v / np.linalg.norm(v)
    w = rng.standard_normal(len(v))
    w -= (w @ u) * u
    return cosine * u + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def planted(rng, lone=5000, dims=64):
    """Vectors without links, pairs, chains, a group of near copies, two dense groups that link across, and exact copies."""
    base = list(rng.standard_normal((lone, dims)))
    pairs = [beside(rng, v, rng.uniform(0.901, 0.99)) for v in base[:300]]
    chains = []
    for v in base[300:330]:
        for _ in range(6):
            v = beside(rng, v, 0.93)
            chains.append(v)
    middle = rng.standard_normal(dims)
    dense = [beside(rng, middle, 0.99) for _ in range(700)]
    other = beside(rng, middle, 0.95)
    across = [beside(rng, other, 0.99) for _ in range(500)]
    return base + pairs + chains + dense + across + dense[:40]


def test_query_against_brute_force(spark, tmp_path):
    """The registered query on rows with links of every kind, well over a run's length."""
    rng = np.random.default_rng(3)
    vecs = [np.asarray(v, np.float32).tolist() for v in planted(rng)]
    ids = [int(i) for i in rng.permutation(len(vecs)) + 10**12]
    spark.createDataFrame(list(zip(ids, vecs, strict=True)), "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op8_embeddings"](spark, str(tmp_path)).collect()
    want = brute(ids, vecs)
    assert len(got) == len(vecs) and len(vecs) > 6000
    links = sum(n for n, _ in want.values())
    assert links > 700_000 and all(r.n_links <= want[r.vec_id][0] for r in got)
    shares = [r.n_links / want[r.vec_id][0] for r in got if want[r.vec_id][0]]
    assert np.mean(shares) >= 0.99 and np.mean([s for r, s in zip([r for r in got if want[r.vec_id][0]], shares, strict=True) if want[r.vec_id][0] < 12]) >= 0.98
    assert sum(want[r.vec_id] == (r.n_links, r.component_id) for r in got) >= 0.99 * len(got)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and got[0].recall >= 0.99


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_on_tables_with_few_links(spark, folder):
    sf = f"/root/testdata/{folder}"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    got = QUERIES["op8_embeddings"](spark, sf).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and got[0].recall >= 0.99


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_saturated_lists_lose_no_link(spark, block_rows):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((40, 16))
    vecs = [c + 0.1 * rng.standard_normal(16) for c, n in zip(centres, [60, 25] + [1, 2, 3] * 13, strict=False) for _ in range(n)]
    vecs = [v.astype(np.float32).tolist() for v in vecs]
    vecs += vecs[:30] + vecs[-1:]
    ids = rng.permutation(len(vecs)).tolist()
    got = near_embeddings(spark.createDataFrame(list(zip(ids, vecs, strict=True)), "vec_id long, embedding array<float>"), k=4, run_rows=40, block_rows=block_rows, target=0.9999).collect()
    assert {r.id: (r.n_links, r.component_id) for r in got} == brute(ids, vecs)


def test_the_search_goes_on_until_the_audit_is_content(spark):
    """Runs far too short for the table: more codes are taken until pairs beside a dense group are found; else it fails."""
    rng = np.random.default_rng(6)
    hot = rng.standard_normal(32) + 0.1 * rng.standard_normal((300, 32))
    lone = rng.standard_normal((1500, 32))
    vecs = np.concatenate([hot, lone, [beside(rng, v, 0.92) for v in lone[:100]]]).astype(np.float32).tolist()
    table = spark.createDataFrame(list(enumerate(vecs)), "vec_id long, embedding array<float>")
    want = brute(range(len(vecs)), vecs)
    got = near_embeddings(table, k=4, trees=1, run_rows=32).collect()
    pairs = [r for r in got if r.id >= 1800]
    assert got[0].recall >= 0.99 and all(r.n_links <= want[r.id][0] for r in got)
    assert sum(r.n_links > 0 for r in pairs) >= 0.95 * len(pairs)
    with pytest.raises(RuntimeError, match="recall"):
        near_embeddings(table, k=4, trees=1, run_rows=4, most_trees=1)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [], 0), (7, [1.0, 2.0, 3.0], 0), (None, [1.0, 0.0], 0), (9, [1.0, 0.0], 0), (8, [2.0, 0.0], 0), (10, [0.0, 3.0], 0), (10, [0.0, 3.0], 0), (11, [-1.0, 0.0], 0), (12, [2.0, 4.0, 6.0], 0), (13, [-1e-300, 1e-320], 0), (14, [-3e300, -1e290], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int")
    got = sorted(((r.id, r.n_links, r.component_id, r.kept) for r in near_embeddings(table).collect()), key=repr)
    want = [*((i, 0, i, True) for i in (1, 2, 3, 4, 5, 6)), (None, 0, None, True), (8, 1, 8, True), (9, 1, 8, False), (10, 1, 10, True), (10, 1, 10, True), (7, 1, 7, True), (12, 1, 7, False)]
    assert got == sorted([*want, (11, 2, 11, True), (13, 2, 11, False), (14, 2, 11, False)], key=repr)
    assert near_embeddings(table.limit(0)).collect() == []
    one = near_embeddings(table.where("vec_id = 9")).collect()
    assert [(r.id, r.n_links, r.component_id, r.kept, r.recall) for r in one] == [(9, 0, 9, True, None)]
    two = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0])], "vec_id long, embedding array<double>")
    assert sorted((r.id, r.n_links, r.component_id) for r in near_embeddings(two).collect()) == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]
    lowest = spark.createDataFrame([(-(2**63), [1.0, 0.0]), (5, [0.0, 1.0]), (6, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted((r.id, r.n_links) for r in near_embeddings(lowest).collect()) == [(-(2**63), 0), (5, 1), (6, 1)]
