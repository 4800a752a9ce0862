"""SimHash near-duplicate groups with pigeonring candidate filtering.

A fingerprint is cut into ``max_distance + 2`` segments in a ring. Two
fingerprints within the distance have some segment from which every run of
consecutive segments keeps within its proportional share of the distance (the
pigeonring principle): the first segment is equal, and so is at least one of
the next two. Equal pairs of segments are therefore the join keys, the running
budgets prune what the keys bring together, and only then the whole distance
is taken.

Keys that many distinct fingerprints share are not paired off. There each
fingerprint emits the patterns within half the distance of its remaining bits;
two fingerprints within the distance share a pattern, and every holder of a
pattern is tied to its least holder, so emission is linear in the group.

``similar_groups`` groups by the similarity of the shingle sets instead. Texts
of similarity 0.8 differ in about ten of 64 bits, where no pair of segments
need be equal; there, texts that share one of their smallest shingle hashes
meet, the running budgets, the whole distance and a one-permutation sketch
prune them, and the shingle sets themselves decide.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.work import lean, map_batches, materialise, rows_in, same_or_null, scoped
from inkmill.operators.graph import connected_components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEED = 42


def shingle_hashes(text: str | None, width: int, seed: int = _SEED) -> np.ndarray:
    """XXH64 of every run of ``width`` words, A-Z lower-cased, repeats included; one hash of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(words) < width:
        return np.array([xxh64_intdigest(b" ".join(words), seed)] if words else [], dtype=np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - width + 1)


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash as a signed long; 0 for a text without words."""
    return _bits(shingle_hashes(text, width))


def _bits(h: np.ndarray) -> int:
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        ones += np.unpackbits(h[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp long) of every row; a map over the scan, without a shuffle."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [fingerprint(t, width) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], ["id", "fp"])

    return map_batches(same_or_null(docs, id_col, text_col), kernel, "id long, fp long")


def _bounds(segments: int) -> list[tuple[int, int]]:
    cuts = [64 * k // segments for k in range(segments + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def _part(fp: Column, lo: int, hi: int) -> Column:
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def _within_ring(x: Column, max_distance: int, segments: int) -> Column:
    """Some start keeps every run of segments within floor(run * distance / segments) of the set bits of ``x``."""
    d = [F.bit_count(_part(x, lo, hi)) for lo, hi in _bounds(segments)]
    starts = []
    for i in range(segments):
        runs = [reduce(lambda p, q: p + q, [d[(i + k) % segments] for k in range(n)]) <= n * max_distance // segments for n in range(1, segments + 1)]
        starts.append(reduce(lambda p, q: p & q, runs))
    return reduce(lambda p, q: p | q, starts)


def _keyed(fps: DataFrame, segments: int) -> DataFrame:
    bounds = _bounds(segments)
    keys = []
    for k, (i, j) in enumerate(combinations(range(segments), 2)):
        (a, b), (c, d) = bounds[i], bounds[j]
        mask = (((1 << (b - a)) - 1) << a) | (((1 << (d - c)) - 1) << c)
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return fps.select("rep", "fp", F.explode(F.array(*keys)).alias("key")).select("rep", "fp", "key.k", "key.bits")


def near_edges(fps: DataFrame, max_distance: int = 2, pair_limit: int = 48) -> DataFrame:
    """Edges (a, b) between representatives that leave the groups of fingerprints within ``max_distance`` connected.

    ``fps``: distinct fp, rep (long). Keys of at most ``pair_limit`` fingerprints
    are paired and filtered; keys of more take the pattern stars, which join
    exactly the same groups.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance is 0, 1 or 2")
    segments = max_distance + 2
    keyed = _keyed(fps, segments)
    counts = keyed.groupBy("k", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(keyed.join(counts, ["k", "bits"]), "keys")

    small = shared.where(F.col("n") <= pair_limit).drop("n")
    left, right = small.withColumnsRenamed({"rep": "a", "fp": "fa"}), small.withColumnsRenamed({"rep": "b", "fp": "fb"})
    x = F.col("fa").bitwiseXOR(F.col("fb"))
    pairs = left.join(right, ["k", "bits"]).where(F.col("fa") < F.col("fb")).where(_within_ring(x, max_distance, segments)).where(F.bit_count(x) <= max_distance)

    flips = [1 << b if b < 63 else -(1 << 63) for b in range(64)]
    free = F.filter(F.array(*map(F.lit, flips)), lambda bit: bit.bitwiseAND(F.col("held")) == 0)
    masks = F.element_at(F.array(*[F.lit(m) for m in _masks(segments)]), F.col("k") + 1)
    hot = shared.where(F.col("n") > pair_limit).withColumn("held", masks)
    patterns = hot.select("k", "bits", "rep", F.explode(F.concat(F.array("fp"), F.transform(free, lambda bit: bit.bitwiseXOR(F.col("fp"))))).alias("pattern"))
    stars = patterns.groupBy("k", "bits", "pattern").agg(F.min("rep").alias("a"), F.collect_list("rep").alias("all")).where(F.size("all") > 1)
    if max_distance == 1:  # a pattern's holders may be two apart: tie only the pattern itself to its neighbours
        stars = hot.select("fp", F.col("rep").alias("a")).distinct().join(patterns.select(F.col("pattern").alias("fp"), F.col("rep").alias("b")), "fp").select("a", "b")
    elif max_distance == 0:
        stars = hot.select(F.col("rep").alias("a"), F.col("rep").alias("b"))
    else:
        stars = stars.select("a", F.explode("all").alias("b"))
    return pairs.select("a", "b").unionByName(stars.where("a <> b")).distinct()


def _masks(segments: int) -> list[int]:
    out = []
    for i, j in combinations(range(segments), 2):
        mask = sum(((1 << (hi - lo)) - 1) << lo for lo, hi in (_bounds(segments)[i], _bounds(segments)[j]))
        out.append(mask - ((mask >> 63) << 64))
    return out


@scoped
def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, max_distance: int = 2) -> DataFrame:
    """Fingerprint every text and group what lies within ``max_distance`` bits, links chained.

    Returns one row per input row: id, fp long, fingerprint string (16 hex
    digits), component_id (smallest id reachable, the row's own included).
    Null and empty texts have fingerprint 0 and link like any other; repeated
    rows share a group; a row with a null id is labelled with its fingerprint's
    group but is no one's label (null if only null ids hold that fingerprint).
    Extra columns are ignored; an empty table gives an empty table.
    """
    marked = materialise(fingerprints(docs, id_col, text_col, width), "simhash")
    fps = materialise(marked.groupBy("fp").agg(F.min("id").alias("rep")), "fps")
    roots = connected_components(near_edges(fps.where("rep is not null"), max_distance))
    labels = fps.join(roots, fps["rep"] == roots["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return marked.join(labels, "fp").select("id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def within_ring(x: np.ndarray, max_distance: int) -> np.ndarray:
    """The running budgets over xor-ed fingerprints (uint64) in eight segments: some start keeps every run within its proportional share."""
    d = np.bitwise_count(np.ascontiguousarray(x)[:, None].view(np.uint8)).astype(np.int16)
    run, ok = np.zeros_like(d), np.ones(d.shape, bool)
    for n in range(1, 9):
        run = run + np.roll(d, -(n - 1), axis=1)
        ok &= run <= n * max_distance // 8
    return ok.any(axis=1)


def _forest(ids: np.ndarray, left: np.ndarray, right: np.ndarray, near) -> list[tuple[int, int]]:
    """Edges that leave connected what ``near`` ties between two lists of places; places already connected are not compared.

    ``near(i, others, group)`` yields those of the places ``others`` that are near place i.
    """
    group, edges = np.arange(len(ids)), []
    for i in left:
        for j in near(i, right[group[right] != group[i]], group):
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                edges.append((int(ids[i]), int(ids[j])))
    return edges


def _loosely(fps: np.ndarray, sketches: np.ndarray, sizes: np.ndarray, similarity: float, max_distance: int):
    """Near by what is small to hold: set sizes, SimHash within its running budgets and distance, and the sketch.

    All are generous. The sketch's bar is five of its standard errors under
    ``similarity``; an error is that of twice the variance of as many draws as
    there are bins or shingles, since few shingles leave bins that are copies.
    The SimHash of a set of under 64 shingles varies too much to prune.
    """

    def near(i, others, group):
        low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        fits = low >= similarity * high - 1e-6
        others, low = others[fits], low[fits]
        few, x = low < 64, fps[others] ^ fps[i]
        fits = few.copy()
        fits[~few] = within_ring(x[~few], max_distance) & (np.bitwise_count(x[~few]) <= max_distance)
        others, low = others[fits], low[fits]
        bar = similarity - 5 * np.sqrt(similarity * (1 - similarity) * 2 / np.minimum(np.maximum(low, 1), sketches.shape[1]))
        return others[(sketches[others] == sketches[i]).mean(axis=1) >= bar].tolist()

    return near


def _exactly(sets: list[np.ndarray], similarity: float):
    """Near by the similarity of the shingle sets themselves."""
    sizes = np.array([len(x) for x in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    parts = [codes[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
    held = np.zeros(len(codes) + 1, bool)

    def near(i, others, group):
        low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        held[parts[i]] = True
        try:
            for j in others[low >= similarity * high - 1e-6]:
                if group[i] != group[j]:
                    both = int(np.count_nonzero(held[parts[j]]))
                    whole = int(sizes[i] + sizes[j]) - both
                    if not whole or both / whole >= similarity:
                        yield j
        finally:
            held[parts[i]] = False

    return near


def _in_blocks(rows: DataFrame, key: str, block_rows: int, block_shingles: int) -> DataFrame:
    """``rows`` (key, node, size, ...) of keys that two or more share, once for each pair of blocks: key, i, j, own, then the other columns."""
    totals = rows.groupBy(key).agg(F.count("*").alias("n"), F.sum("size").alias("all")).where("n > 1")
    blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.ceil(F.col("all") / block_shingles)).cast("int")
    met = rows.join(totals.select(key, blocks.alias("blocks")), key).withColumn("own", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("blocks")).cast("int"))
    spread = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *[c for c in rows.columns if c != key])


def _edges_of_blocks(sent: DataFrame, key: str, near_of) -> DataFrame:
    """(a, b): the forest of every pair of blocks; ``near_of`` makes a comparison from a group's columns after ``own`` and ``node``."""
    at = sent.columns.index("node")

    def compare(batches):
        now, group = None, []

        def edges() -> list[tuple[int, int]]:
            own, ids = np.array([r[0] for r in group]), np.array([r[at - 3] for r in group], np.int64)
            left, right = (np.nonzero(own == k)[0] for k in now[1:])
            return _forest(ids, left, right, near_of(group))

        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 256):
                for k, i, j, *row in zip(*(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True):
                    if (k, i, j) != now:
                        found += edges() if len(group) > 1 else []
                        now, group = (k, i, j), []
                    group.append(row)
            yield _edge_batch(found)
        yield _edge_batch(edges() if len(group) > 1 else [])

    return sent.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node").mapInArrow(lean(compare), "a long, b long")


@scoped
def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, width: int = 5, anchors: int = 6, max_distance: int = 24, block_rows: int = 1024, block_shingles: int = 2_000_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """Group texts whose ``width``-word shingle sets are similar, links chained: id, ``carry`` columns, fp, component_id, group.

    Every text brings its SimHash (of its set of shingles, repeats counted
    once), its ``anchors`` smallest shingle hashes and a sketch of 256 bins.
    Texts that share an anchor meet, in blocks of about ``block_rows`` rows
    that are compared a pair of blocks at a time; what a block emits is a
    forest, so emission is linear whatever the size of a group. There set
    sizes, the SimHash's running budgets within ``max_distance`` bits and the
    sketch prune generously. Only texts that are left with a partner are read
    again; their shingle sets meet in blocks within the groups of what was not
    pruned, and the exact similarity of the sets decides.

    Texts with equal sets are copies. Null, empty and blank texts are copies of
    each other. ``group`` is the same for the rows of a group and never null;
    component_id is the group's smallest id (null if only null ids are in it).
    Repeated rows and null ids are rows like any other; extra columns are
    ignored; an empty table gives an empty table.
    """
    from xxhash import xxh3_128_digest

    from inkmill.llm.minhash import OnePermutation

    scheme = OnePermutation(bin_bits=8, low_bits=8, width=width)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), *[F.col(f"`{c}`") for c in carry])
    keys = [F.xxhash64(F.lit(k), F.col("id").isNull(), "id", F.col("text").isNull(), "text").alias(f"row{k}") for k in (1, 2)]
    rows = rows.select("*", *keys)
    kept = ["id", *carry, "row1", "row2"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column(0).to_pylist():
            own = np.unique(shingle_hashes(text, width))
            out.append((_bits(own), scheme.packed(scheme.from_hashes(own)), own[:anchors].view(np.int64).tolist() or [0], len(own), xxh3_128_digest(own.tobytes())))
        columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.binary()), strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], [*kept, "fp", "sketch", "anchors", "size", "digest"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", fp long, sketch binary, anchors array<long>, size int, digest binary"
    marked = materialise(map_batches(rows.select("text", *kept), mark, schema), "marks")
    facts = F.first(F.struct("fp", "sketch", "anchors", "size")).alias("x")
    reader = F.min(F.struct("row1", "row2")).alias("reader")
    nodes = materialise(marked.groupBy("digest").agg(F.min("id").alias("rep"), reader, facts).select(F.xxhash64("digest").alias("node"), "digest", "rep", "reader.*", "x.*"), "nodes")

    def loose(group: list):
        fps, sizes = np.array([r[2] for r in group], np.int64).view(np.uint64), np.array([r[4] for r in group])
        return _loosely(fps, np.frombuffer(b"".join(r[3] for r in group), np.uint8).reshape(len(group), -1), sizes, similarity, max_distance)

    met = _in_blocks(nodes.select(F.explode("anchors").alias("anchor"), "node", "fp", "sketch", "size"), "anchor", block_rows, 1 << 62)
    roots = materialise(connected_components(_edges_of_blocks(met, "anchor", loose)), "loose")

    def exact(group: list):
        return _exactly([np.frombuffer(r[3], np.uint64) for r in group], similarity)

    def shingles(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.unique(shingle_hashes(t, width)).tobytes() for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(map(xxh3_128_digest, own), pa.binary()), pa.array(own, pa.binary())], ["digest", "shingles"])

    members = materialise(nodes.join(roots, "node").select("component", "node", "digest", "size", "row1", "row2"), "members")
    read = map_batches(rows_in(rows.select("text", "row1", "row2"), members, ["row1", "row2"]).select("text"), shingles, "digest binary, shingles binary")
    sets = read.groupBy("digest").agg(F.first("shingles").alias("shingles"))
    whole = _in_blocks(members.join(sets, "digest").select("component", "node", "size", "shingles"), "component", block_rows, block_shingles)
    roots = connected_components(_edges_of_blocks(whole, "component", exact))
    grouped = nodes.select("node", "digest", "rep").join(roots, "node", "left").select("digest", "rep", F.coalesce("component", "node").alias("group"))
    labels = grouped.join(grouped.groupBy("group").agg(F.min("rep").alias("component_id")), "group").select("digest", "group", "component_id")
    return marked.join(labels, "digest").select("id", *carry, "fp", "component_id", "group")


def row_keys(docs: DataFrame) -> list[Column]:
    """Two hashes (_key1, _key2) over all columns of a row; rows that are equal throughout have equal keys."""
    parts = []
    for field in docs.schema.fields:
        value = F.col(f"`{field.name}`")
        parts += [value.isNull(), F.array_sort(F.map_entries(value)) if field.dataType.typeName() == "map" else value]
    return [F.xxhash64(F.lit(k), *parts).alias(f"_key{k}") for k in (1, 2)]


@scoped
def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8, width: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: of each group of ``similar_groups`` one row stays.

    It is the one with the smallest id, null ids last, then with the smallest
    hash of the whole row; rows that are equal throughout count once. The texts
    are not shuffled as long as the rows to drop are few enough to be sent to
    the scan (``rows_in``).
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(whole, F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), *row_keys(docs))
    key = ["_key1", "_key2"]
    groups = similar_groups(keyed, "id", "text", similarity, width, carry=tuple(key))
    rows = materialise(groups.groupBy("group", "id", *key).agg(F.count("*").alias("n")), "groups")
    row = F.struct(F.col("id").isNull().alias("last"), "id", *key)
    fate = rows.join(rows.groupBy("group").agg(F.min(row).alias("first")), "group").withColumn("stays", row.eqNullSafe(F.col("first")))
    fate = materialise(fate.select(*key, "stays", "n"), "fate")
    left = rows_in(keyed.select("row", *key), fate.where("not stays"), key, keep=False)
    repeated = fate.where("stays and n > 1")
    if repeated.limit(1).count():
        once = rows_in(left, repeated, key).groupBy(*key).agg(F.first("row").alias("row")).select("row")
        left = rows_in(left, repeated, key, keep=False).select("row").union(once)
    return left.select("row.*")


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in edges], pa.int64()), pa.array([b for _, b in edges], pa.int64())], ["a", "b"])
