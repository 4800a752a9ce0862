"""Near-duplicate embeddings by NN-descent.

Equal vectors become one node. A first neighbour graph comes from sorting the
nodes by random-hyperplane codes, several times, and comparing each run of
``run_rows`` consecutive nodes; runs are of equal length whatever the data.
Rounds of NN-descent then compare the neighbours of a node, forward and
reverse, with each other, and keep each node's best k.

A node whose whole list is over the threshold is saturated. Its list gets
twice the room and is filled by comparing what surrounds it; a list whose new
room is half full of links is taken for saturated again, and its node is
compared with its whole component, a pair of blocks at a time, so no cap cuts
the number of links. Where a run holds more links than lists keep, the
run also gives ties, a spanning forest of its links, which join components
that lists full of nearer nodes would leave apart.

The recall is audited in one pass over all vectors, against sampled nodes and
against probes: vectors planted just over the threshold beside sampled nodes,
which take part in the search and are left out of the result, so that a recall
is measured however rare links are. Until the probes' lists reach the target,
and as long as the whole audit is below it, the search goes on with twice as
many codes. Edges at or over the threshold are the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.work import broadcast_if_small, discard, materialise, rows_in, same_or_null, scoped
from inkmill.operators.graph import connected_components

_PAIR = "a long, b long, sim double, tie boolean"


def _matrix(column: pa.Array, dtype: str) -> np.ndarray:
    """The rows of a binary column as unit vectors; they are of one length."""
    n = len(column)
    if not n:
        return np.empty((0, 0))
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].tobytes()
    x = np.frombuffer(raw, dtype).reshape(n, -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows whose first ``keys`` columns, whole numbers, are equal."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([_numbers(batch.column(k)) for k in range(keys)])
        starts = np.concatenate([[0], np.nonzero((values[:, 1:] != values[:, :-1]).any(axis=0))[0] + 1, [batch.num_rows]])
        for a, b in zip(starts, starts[1:], strict=False):
            key = values[:, a].tolist()
            if held and key != now:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
            now = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, k: int) -> pa.Array:
    return table.column(k).chunk(0)


def _pairs(a, b, sim, tie=False) -> pa.RecordBatch:
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64()), pa.array(np.full(len(a), tie))]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "sim", "tie"])


def vectors(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(id, v binary or null) of every row, and the element type; v is null where a vector cannot link with anything."""
    dtype = "<f4" if rows.schema[vec_col].dataType.elementType.typeName() == "float" else "<f8"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten()  # without the elements of null rows
            x = _numbers(flat).astype(dtype)  # a null element becomes NaN
            there = _numbers(column.is_valid())
            sizes = np.where(there, _numbers(column.value_lengths().fill_null(0)), 0)
            ends = np.cumsum(sizes)
            bad, some = (np.concatenate([[0], np.cumsum(c)]) for c in (~np.isfinite(x), x != 0))
            fits = (bad[ends] == bad[ends - sizes]) & (some[ends] > some[ends - sizes])
            out = [x[b - n : b].tobytes() if ok else None for b, n, ok in zip(ends.tolist(), sizes.tolist(), fits.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(out, pa.binary())], ["id", "v"])

    return same_or_null(rows, id_col, vec_col).mapInArrow(kernel, "id long, v binary"), dtype


def _spanning(linked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows, columns) of true cells that leave connected what the cells connect, fewer than rows and columns together."""
    rows, columns = linked.any(1), linked.any(0)
    while rows.any():
        front = np.array([rows.argmax()])
        rows[front] = False
        while len(front):
            new = np.nonzero(linked[front].any(0) & columns)[0]
            columns[new] = False
            yield front[linked[np.ix_(front, new)].argmax(0)] if len(new) else new, new
            after = np.nonzero(linked[:, new].any(1) & rows)[0]
            rows[after] = False
            yield after, new[linked[np.ix_(after, new)].argmax(1)] if len(after) else after
            front = after


def first_graph(nodes: DataFrame, dtype: str, centres: dict[int, np.ndarray], k: int, threshold: float, trees: range, run_rows: int, seed: int, probes: range) -> DataFrame:
    """(a, b, sim, tie): each node's best k / 2 within its run of consecutive codes, for each set of hyperplanes in ``trees``; and ties.

    ``centres``: length of a vector in bytes -> a point amid the vectors of
    that length, through which the hyperplanes pass. ``probes``: numbers of
    nodes that tie nothing.
    """

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = _numbers(pc.binary_length(batch.column(1)))
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                unit, centre = _matrix(part.column(1), dtype), centres[size]
                for tree in trees:
                    planes = np.random.default_rng([seed, tree, size]).standard_normal((unit.shape[1], 62))
                    code = ((unit @ planes > centre @ planes) @ (1 << np.arange(61, -1, -1, dtype=np.int64))).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([tree] * len(unit), pa.int32()), pa.array([size] * len(unit), pa.int32()), pa.array(code), part.column(0), part.column(1)], ["tree", "size", "code", "node", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, run_rows):
            ids, unit = _numbers(_column(run, 3)), _matrix(_column(run, 4), dtype)
            sims = unit @ unit.T
            np.fill_diagonal(sims, -2)
            n = min(max(2, k // 2), len(ids) - 1)
            if not n:
                continue
            at = np.argpartition(-sims, n - 1, axis=1)[:, :n]
            row = np.repeat(np.arange(len(ids)), n)
            yield _pairs(ids[row], ids[at.ravel()], sims[row, at.ravel()])
            linked = sims >= threshold
            if linked.sum(axis=1).max() > n:  # more links than lists keep
                real = np.nonzero((ids < probes.start) | (ids >= probes.stop))[0]
                ends = list(_spanning(linked[np.ix_(real, real)]))
                if ends:
                    p, q = (real[np.concatenate(x)] for x in zip(*ends, strict=True))
                    yield _pairs(ids[p], ids[q], sims[p, q], True)

    coded = nodes.select("node", "v").mapInArrow(codes, "tree int, size int, code long, node long, v binary")
    order = ["tree", "size", "code", F.xxhash64("tree", "node")]
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, _PAIR)


def _runs(batches: Iterator[pa.RecordBatch], run_rows: int) -> Iterator[pa.Table]:
    """Runs of at most ``run_rows`` rows of one tree and one length."""
    held, now, n = [], None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([_numbers(batch.column(k)) for k in (0, 1)])
        starts = np.concatenate([[0], np.nonzero((values[:, 1:] != values[:, :-1]).any(axis=0))[0] + 1, [batch.num_rows]])
        for a, b in zip(starts, starts[1:], strict=False):
            if values[:, a].tolist() != now:
                if held:
                    yield pa.Table.from_batches(held).combine_chunks()
                held, now, n = [], values[:, a].tolist(), 0
            while a < b:
                m = min(b - a, run_rows - n)
                held.append(batch.slice(a, m))
                a, n = a + m, n + m
                if n == run_rows:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def keep_best(pairs: DataFrame, k: int, limits: DataFrame | None = None) -> DataFrame:
    """Each node's best k distinct neighbours, or as many as ``limits`` (a, most) grants it."""
    once = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    most = F.lit(k)
    if limits is not None:
        once, most = once.join(limits.select("a", "most"), "a", "left"), F.coalesce("most", F.lit(k))
    return once.withColumn("r", rank).where(F.col("r") <= most).select("a", "b", "sim")


def descend(graph: DataFrame, nodes: DataFrame, dtype: str, k: int, limits: DataFrame | None = None, growing: bool = False) -> DataFrame:
    """One round: the members around each node (itself, its neighbours, up to k reverse ones) are compared with each other.

    Returns each member's best k pairs that are better than what its list holds
    last. Lists in ``limits`` (a, most, n) have room for ``most``; ``growing``
    goes only around those that it does not fill with links.
    """
    lists, heads, back = graph, nodes.select("node"), graph.select(F.col("b").alias("w"), F.col("a").alias("x"))
    if growing:
        heads = limits.where("n < most").select(F.col("a").alias("node"))
        lists, back = graph.join(heads.withColumnRenamed("node", "a"), "a", "left_semi"), back.join(heads.withColumnRenamed("node", "w"), "w", "left_semi")
    rank = F.row_number().over(Window.partitionBy("w").orderBy(F.xxhash64("x", "w"), "x"))
    back = back.withColumn("r", rank).where(F.col("r") <= k).drop("r")
    around = lists.select(F.col("a").alias("w"), F.col("b").alias("x")).unionByName(back).unionByName(heads.select(F.col("node").alias("w"), F.col("node").alias("x"))).distinct()
    room = F.lit(k) if limits is None else F.coalesce(F.first("most"), F.lit(k))
    last = (graph if limits is None else graph.join(limits, "a", "left")).groupBy("a").agg(F.when(F.count("*") >= room, F.min("sim")).alias("last"))
    held = nodes.join(last, nodes["node"] == last["a"], "left").select(F.col("node").alias("x"), "v", F.coalesce("last", F.lit(-2.0)).alias("last"))
    members = around.join(held, "x").select("w", "x", "v", "last")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = [], 0
        for group in _groups(batches, 1):
            ids, unit, last = _numbers(_column(group, 1)), _matrix(_column(group, 2), dtype), _numbers(_column(group, 3))
            sims = unit @ unit.T
            np.fill_diagonal(sims, -3)
            if len(ids) > k + 1:
                last = np.maximum(last, -np.partition(-sims, k, axis=1)[:, k])
            i, j = np.nonzero(sims > last[:, None])
            out.append((ids[i], ids[j], sims[i, j]))
            n += len(i)
            if n > 50_000:
                yield _pairs(*map(np.concatenate, zip(*out, strict=True)))
                out, n = [], 0
        if out:
            yield _pairs(*map(np.concatenate, zip(*out, strict=True)))

    return members.repartition("w").sortWithinPartitions("w").mapInArrow(local, _PAIR)


def _against_all(nodes: DataFrame, dtype: str, queries: list[tuple[int, bytes]], threshold: float) -> dict[int, tuple[int, int]]:
    """Links of each query (number, vector) to the vectors of all ``nodes`` (node, v, copies) but itself, in one pass: with copies, and nodes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, list] = {}
        for i, raw in queries:
            by_size.setdefault(len(raw), []).append((i, raw))
        held = {s: (np.array([i for i, _ in q]), _matrix(pa.array([r for _, r in q], pa.binary()), dtype), np.zeros((len(q), 2), np.int64)) for s, q in by_size.items()}
        for batch in batches:
            sizes = _numbers(pc.binary_length(batch.column(1)))
            for size in np.unique(sizes).tolist():
                if size in held:
                    part, (ids, unit, total) = batch.filter(pa.array(sizes == size)), held[size]
                    for at in range(0, part.num_rows, 2048):
                        rows = part.slice(at, 2048)
                        linked = (unit @ _matrix(rows.column(1), dtype).T >= threshold) & (ids[:, None] != _numbers(rows.column(0)))
                        copies = _numbers(rows.column(2))
                        total += linked @ np.stack([copies, copies > 0], axis=1)
        for ids, _, total in held.values():
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[:, 0]), pa.array(total[:, 1])], ["node", "n", "d"])

    counted = nodes.select("node", "v", "copies").mapInArrow(count, "node long, n long, d long").groupBy("node").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    return {i: (0, 0) for i, _ in queries} | {r.node: (r.n, r.d) for r in counted.collect()}


def probes_beside(chosen: list, dtype: str, threshold: float, first: int, seed: int) -> list[tuple[int, bytes]]:
    """(number, vector): beside each chosen vector one at a random angle whose cosine is just over the threshold."""
    rng, out = np.random.default_rng([seed, 99]), []
    for n, (_, raw) in enumerate(chosen):
        unit = _matrix(pa.array([raw], pa.binary()), dtype)[0]
        aside = rng.standard_normal(len(unit))
        aside -= (aside @ unit) * unit
        size = np.sqrt(aside @ aside)
        if len(unit) > 1 and size > 0:
            cosine = threshold + (1 - threshold) * rng.uniform(0.001, 0.25)
            out.append((first + n, (cosine * unit + np.sqrt(1 - cosine**2) * aside / size).astype(dtype).tobytes()))
    return out


def _by_component(saturated: DataFrame, members: DataFrame, dtype: str, threshold: float, block_rows: int) -> DataFrame:
    """(node, n): links of saturated nodes within their components, and of the other members to saturated ones.

    ``saturated`` and ``members``: component, node, v, copies; members also
    ``full`` (is saturated). Saturated nodes and members are cut into blocks of
    about ``block_rows``, and a task compares a block of each.
    """

    def blocks(rows: DataFrame, n: str) -> DataFrame:
        return rows.groupBy("component").agg(F.ceil(F.count("*") / block_rows).cast("int").alias(n))

    grid = broadcast_if_small(blocks(saturated, "p").join(blocks(members, "q"), "component"))

    def sent(rows: DataFrame, own: str, other: str, side: int) -> DataFrame:
        placed = rows.join(grid, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col(own)).cast("int"))
        spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        i, j = ("own", "other") if side == 0 else ("other", "own")
        return spread.select("component", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(side).alias("side"), "node", "v", "copies", "full")

    both = sent(saturated.withColumn("full", F.lit(True)), "p", "q", 0).unionByName(sent(members, "q", "p", 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            side, ids, copies, full = (_numbers(_column(group, k)) for k in (3, 4, 6, 7))
            unit = _matrix(_column(group, 5), dtype)
            a, b = np.nonzero(side == 0)[0], np.nonzero(side == 1)[0]
            back, plain = np.zeros(len(b), np.int64), ~full[b].astype(bool)
            for at in range(0, len(a), 1024):
                rows = a[at : at + 1024]
                linked = (unit[rows] @ unit[b].T >= threshold) & (ids[rows, None] != ids[b])
                back += copies[rows] @ linked
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(linked @ copies[b])], ["node", "n"])
            yield pa.RecordBatch.from_arrays([pa.array(ids[b][plain]), pa.array(back[plain])], ["node", "n"])

    order = ["component", "i", "j"]
    return both.repartition(*order).sortWithinPartitions(*order).mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))


def _limits(graph: DataFrame, threshold: float, k: int) -> DataFrame:
    """(a, most, n): every list with k links or more has room for 2 k; it holds n links."""
    counts = graph.where(F.col("sim") >= threshold).groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    return materialise(counts.select("a", F.lit(2 * k).alias("most"), "n"), "limits")


def _found(graph: DataFrame, ties: DataFrame, nodes: DataFrame, dtype: str, threshold: float, full: DataFrame, block_rows: int, probes: range) -> DataFrame:
    """Nodes with n (links to other nodes' vectors), full (counted against the whole component) and component.

    ``nodes``: node, v, copies, which is 0 for probes; they count as links of no
    one and connect nothing. ``full``: a, the nodes whose lists are saturated.
    """
    links = graph.where(F.col("sim") >= threshold).select("a", "b")
    real = links.where(~F.col("a").between(probes.start, probes.stop - 1) & ~F.col("b").between(probes.start, probes.stop - 1))
    roots = materialise(connected_components(real.unionByName(ties)), "roots")
    beside = links.where(F.col("a").between(probes.start, probes.stop - 1)).join(roots, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("component"))
    roots = roots.unionByName(beside.select(F.col("a").alias("node"), "component"))
    room = full.select(F.col("a").alias("node"), F.lit(True).alias("full"))
    facts = materialise(nodes.join(room, "node", "left").withColumn("full", F.coalesce("full", F.lit(False))).join(roots, "node", "left"), "facts")
    dense = materialise(facts.where("full").select("component").distinct(), "dense")
    members = rows_in(facts, dense, ["component"]).select("component", "node", "v", "copies", "full")
    whole = _by_component(members.where("full").drop("full"), members, dtype, threshold, block_rows)
    plain = facts.where("not full").select(F.col("node").alias("b"), "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    listed = both.join(plain, "b").join(plain.select(F.col("b").alias("a")), "a", "left_semi").groupBy("a").agg(F.sum("copies").alias("n")).withColumnRenamed("a", "node")
    n = listed.unionByName(whole).groupBy("node").agg(F.sum("n").alias("n"))
    found = facts.join(n, "node", "left").select(*nodes.columns, F.coalesce("n", F.lit(0)).alias("n"), "full", "component")
    return materialise(found, "found")


@scoped
def near_embeddings(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, k: int = 8, trees: int = 10, run_rows: int = 2048, rounds: int = 1, target: float = 0.99, sample: int = 1000, most_trees: int = 4096, block_rows: int = 512, seed: int = 8) -> DataFrame:
    """Links between vectors with cosine >= ``threshold``, and their components.

    Returns one row per input row: id, n_links (other vectors linked directly,
    copies included), component_id (smallest id reachable by links, its own
    included), kept (id is component_id), recall (of the audit: the least of
    the mean shares of links found, over probes, over sampled nodes whose list
    holds their links, and over sampled nodes counted against their component;
    null without two different vectors). ``target`` is the recall from which
    the search may end; with ``most_trees`` codes below it, the call fails.

    Vectors that are null, empty, zero, hold null or non-finite components, and
    rows with a null id, link with nothing; such a row is its own component
    (null for a null id). Vectors of different lengths do not link. Rows that
    repeat an id and its vector are vectors of their own. Extra columns are
    ignored; an empty table gives an empty table.
    """
    spark = rows.sparkSession
    raw, dtype = vectors(rows, id_col, vec_col)
    raw = materialise(raw, "vectors")
    usable = raw.where("v is not null and id is not null")
    nodes = materialise(usable.groupBy("v").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "nodes")
    shared = nodes.groupBy("node").count().where("count > 1").limit(1).count() > 0  # an id with several vectors: number the vectors instead
    nodes = nodes.withColumn("least", F.col("node")).withColumn("node", F.xxhash64("v") if shared else F.col("node"))

    chosen = [(r.node, bytes(r.v)) for r in nodes.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(sample).select("node", "v").collect()]
    lowest = nodes.agg(F.min("node")).first()[0] or 0
    free = lowest - len(chosen) if lowest >= len(chosen) - 2**63 else nodes.agg(F.max("node")).first()[0] + 1
    planted = probes_beside(chosen[: (sample + 1) // 2], dtype, threshold, free, seed) if len(chosen) > 1 else []
    probes = range(free, free + len(chosen))
    if planted:
        table = spark.createDataFrame([(bytearray(v), i, 0, None) for i, v in planted], "v binary, node long, copies long, least long")
        nodes = materialise(nodes.unionByName(table), "searched")
    centres: dict[int, np.ndarray] = {}
    for size in {r.n for r in nodes.select(F.length("v").alias("n")).distinct().collect()}:
        of = [v for _, v in chosen if len(v) == size]
        centres[size] = _matrix(pa.array(of, pa.binary()), dtype).mean(axis=0) if of else np.zeros(size // int(dtype[2]))

    graph = ties = limits = None
    done, true, recall = 0, None, None
    while True:
        more = range(done, 2 * done or trees)
        if done >= most_trees:
            raise RuntimeError(f"recall {recall:.4f} is under {target} with {done} codes")
        runs = materialise(first_graph(nodes, dtype, centres, k, threshold, more, run_rows, seed, probes), "runs")
        done = more.stop
        found = runs.where("not tie").select("a", "b", "sim")
        graph, old = materialise(keep_best(found if graph is None else graph.unionByName(found), k, limits), "graph"), graph
        tied = runs.where("tie").select("a", "b")
        ties, old_ties = materialise((tied if ties is None else ties.unionByName(tied)).distinct(), "ties"), ties
        discard(*[t for t in (runs, old, old_ties) if t is not None])
        for _ in range(rounds):
            graph = _round(graph, nodes, dtype, k, limits)
        if planted:
            true = _against_all(nodes, dtype, chosen + planted, threshold + 1e-9) if true is None else true
            recall = _listed_recall(graph, true, threshold, k, probes)
            if recall < target:
                continue
        limits = _limits(graph, threshold, k)
        if limits.where("n < most").limit(1).count():
            graph = _round(graph, nodes, dtype, k, limits, growing=True)
            limits = _limits(graph, threshold, k)
        result = _found(graph, ties, nodes, dtype, threshold, limits.where(F.col("n") >= k + k // 2), block_rows, probes)
        if not planted:
            break
        recall = _recall(result, true, probes)
        if recall >= target:
            break
        discard(result)

    facts = result.where("copies > 0").select("v", "least", "component", (F.col("n") + F.col("copies") - 1).alias("n_links"))
    least = facts.where("component is not null").groupBy("component").agg(F.min("least").alias("first"))
    facts = facts.join(broadcast_if_small(least), "component", "left").select("v", "n_links", F.coalesce("first", "least").alias("component_id"))
    linked = usable.join(facts, "v").select("id", "n_links", "component_id")
    alone = raw.where("v is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select("id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), F.lit(recall).cast("double").alias("recall"))


def _round(graph: DataFrame, nodes: DataFrame, dtype: str, k: int, limits: DataFrame | None, growing: bool = False) -> DataFrame:
    after = materialise(keep_best(graph.unionByName(descend(graph, nodes, dtype, k, limits, growing).select("a", "b", "sim")), k, limits), "graph")
    discard(graph)
    return after


def _listed_recall(graph: DataFrame, true: dict[int, tuple[int, int]], threshold: float, k: int, probes: range) -> float:
    """Mean share of the probes' linked nodes that their lists hold; a list that is full of links counts as whole here."""
    own = graph.where(F.col("a").between(probes.start, probes.stop - 1) & (F.col("sim") >= threshold))
    held = {r.a: (r.n, r.d) for r in own.groupBy("a").agg(F.count("*").alias("n"), F.count_if(~F.col("b").between(probes.start, probes.stop - 1)).alias("d")).collect()}
    shares = [1.0 if held.get(i, (0, 0))[0] >= k else min(1.0, held.get(i, (0, 0))[1] / d) for i, (_, d) in true.items() if i in probes and d]
    return float(np.mean(shares or [1.0]))


def _recall(found: DataFrame, true: dict[int, tuple[int, int]], probes: range) -> float:
    """The least of the mean shares of links found, by kind of node; kinds of fewer than 20 nodes with links are averaged with the probes."""
    ids = found.sparkSession.createDataFrame([(i,) for i, (n, _) in true.items() if n], "node long")
    kinds: dict[str, list[float]] = {}
    for r in found.join(F.broadcast(ids), "node").select("node", "n", "full").collect():
        kind = "probe" if r.node in probes else "whole" if r.full else "listed"
        kinds.setdefault(kind, []).append(min(r.n, true[r.node][0]) / true[r.node][0])
    few = [x for kind, of in kinds.items() if kind == "probe" or len(of) < 20 for x in of]
    return float(min(np.mean(of) for of in [few or [1.0], *[of for kind, of in kinds.items() if kind != "probe" and len(of) >= 20]]))
