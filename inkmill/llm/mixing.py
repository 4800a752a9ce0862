"""Mix sources to target weights with a min-cost flow over membership patterns.

Documents are totalled by the set of sources they belong to (their pattern).
On the driver, one small network routes words from patterns to source quotas:
each pattern offers its words once for free and again at rising cost, so words
are repeated only where a quota cannot be met otherwise. The flow of a pattern
says how many whole passes over its documents are taken and how many words of
one more pass; which documents that pass takes follows from a seeded hash.

The hash is cut into buckets, whose totals tell in which bucket a pattern's
last pass ends. Only the rows of that one bucket are ranked; all other rows
are decided where they are scanned, whatever the size of their source.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.work import materialise, same_or_null, scoped

#: A word: a run of anything but space and the five ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
MAX_PATTERNS = 20_000
BUCKET_BITS = 14
#: Decided rows of last buckets that are sent to the scan; beyond, they meet their rows in a join.
MAX_CHOSEN = 200_000


def water_fill(sizes: dict, weights: dict, limit: int) -> dict:
    """Share the total of ``sizes`` by weight; a share stops at ``limit`` times its size and the excess is shared again."""
    left, fixed, active = Fraction(sum(sizes.values())), {}, [s for s in sizes if sizes[s]]
    while active:
        total = sum(weights[s] for s in active)
        over = [s for s in active if left * weights[s] / total > limit * sizes[s]]
        if not over:
            fixed |= {s: left * weights[s] / total for s in active}
            break
        for s in over:
            fixed[s] = Fraction(limit * sizes[s])
        left -= sum(fixed[s] for s in over)
        active = [s for s in active if s not in over]
    return {s: fixed.get(s, Fraction(0)) for s in sizes}


def whole_quotas(targets: dict) -> dict:
    """Round targets to whole words by largest remainder; the total is kept."""
    quotas = {s: int(t) for s, t in targets.items()}
    short = round(sum(targets.values()) - sum(quotas.values()))
    for s in sorted(targets, key=lambda s: quotas[s] - targets[s])[:short]:
        quotas[s] += 1
    return quotas


def _augment(heads: list[list[int]], arcs: list[list[int]]) -> None:
    """Raise the flow from node 0 to node 1 to its maximum by blocking flows in layers; arcs are [to, capacity left], reverse at index ^ 1."""
    while True:
        layer = [-1] * len(heads)
        layer[0], queue = 0, deque([0])
        while queue:
            a = queue.popleft()
            for i in heads[a]:
                b, capacity = arcs[i]
                if capacity and layer[b] < 0:
                    layer[b] = layer[a] + 1
                    queue.append(b)
        if layer[1] < 0:
            return
        tried, path = [0] * len(heads), []
        while True:
            a = arcs[path[-1]][0] if path else 0
            if a == 1:
                amount = min(arcs[i][1] for i in path)
                for i in path:
                    arcs[i][1] -= amount
                    arcs[i ^ 1][1] += amount
                path = path[: next(k for k, i in enumerate(path) if not arcs[i][1])]
                continue
            while tried[a] < len(heads[a]):
                i = heads[a][tried[a]]
                if arcs[i][1] and layer[arcs[i][0]] == layer[a] + 1:
                    path.append(i)
                    break
                tried[a] += 1
            else:
                if not path:
                    break
                tried[arcs[path.pop() ^ 1][0]] += 1


def min_cost_flow(patterns: dict[tuple, int], quotas: dict, limit: int) -> dict[tuple, dict]:
    """Words routed from each pattern to each of its sources.

    The k-th pass over a pattern costs (k-1)^2 a word, so costs are convex.
    Only the arcs that open a pass cost anything, and no path comes back to
    where it began, so a path costs what its first arc costs: a cheapest flow
    fills the quotas as far as first passes go, then from there as far as
    second passes go, and so on up to ``limit``.
    """
    names = ["from", "to", *patterns, *[("source", s) for s in quotas]]
    number = {n: i for i, n in enumerate(names)}
    heads: list[list[int]] = [[] for _ in names]
    arcs: list[list[int]] = []

    def arc(a: int, b: int, capacity: int) -> int:
        heads[a].append(len(arcs))
        arcs.append([b, capacity])
        heads[b].append(len(arcs))
        arcs.append([a, 0])
        return len(arcs) - 2

    opened = {p: arc(0, number[p], 0) for p in patterns}
    routes = {(p, s): arc(number[p], number["source", s], limit * words) for p, words in patterns.items() for s in p}
    for s, quota in quotas.items():
        arc(number["source", s], 1, quota)
    for _ in range(limit):
        for p, words in patterns.items():
            arcs[opened[p]][1] += words
        _augment(heads, arcs)
    flow: dict[tuple, dict] = {p: {} for p in patterns}
    for (p, s), i in routes.items():
        flow[p][s] = arcs[i ^ 1][1]
    return flow


@dataclass(frozen=True)
class Mix:
    """What the driver decided: a row per pattern and a row per source."""

    patterns: DataFrame  # key, passes, rest, last_bucket, before
    keys: dict[str, tuple]
    sources: dict  # source -> (size, target)
    flow: dict[tuple, dict]


def _pattern(source: Column, is_array: bool) -> Column:
    one = F.array(source) if not is_array else F.when(F.size(source) > 0, F.array_sort(F.array_distinct(source))).otherwise(F.array(F.lit(None).cast("string")))
    return F.to_json(F.struct(one.alias("p")), {"ignoreNullFields": "false"})


def marked(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """row (the whole row as a struct), id, _key (pattern), _size (words), _hash and _bucket; nothing is shuffled.

    The seeded hash is over all columns, so only rows that are equal throughout share it.
    """
    is_array = docs.schema[source_col].dataType.typeName() == "array"
    parts = [F.lit(seed)]
    for field in docs.schema.fields:
        value = F.col(f"`{field.name}`")
        parts += [value.isNull(), F.array_sort(F.map_entries(value)) if field.dataType.typeName() == "map" else value]
    h = F.xxhash64(*parts)
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        _pattern(F.col(f"`{source_col}`"), is_array).alias("_key"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("_size"),
        h.alias("_hash"),
        F.shiftrightunsigned(h, 64 - BUCKET_BITS).cast("int").alias("_bucket"),
    )


def plan_mix(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, max_patterns: int = MAX_PATTERNS) -> Mix:
    """Totals, targets, flow and where each pattern's last pass ends. ``rows``: _key, _size, _bucket.

    Sources in code-point order, null last, weigh ``weights`` in turn. What
    reaches the driver is a row per pattern; more than ``max_patterns`` raise.
    """
    spark = rows.sparkSession
    by_bucket = materialise(rows.groupBy("_key", "_bucket").agg(F.sum("_size").alias("words")), "buckets")
    totals = by_bucket.groupBy("_key").agg(F.sum("words").alias("words")).limit(max_patterns + 1).collect()
    if len(totals) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    keys = {r._key: tuple(json.loads(r._key)["p"]) for r in totals}
    patterns = {keys[r._key]: r.words for r in sorted(totals)}
    sizes: dict = {}
    for p, words in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + words
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    whole = sum(patterns.values())
    targets = water_fill({s: sizes[s] for s in order}, {s: weights[i % len(weights)] for i, s in enumerate(order)}, limit)
    scale = Fraction(whole, sum(sizes.values())) if sum(sizes.values()) else Fraction(0)  # overlapping sources count a document more than once
    targets = {s: t * scale for s, t in targets.items()}
    flow = min_cost_flow(patterns, whole_quotas(targets), limit)
    taken = [(k, *divmod(sum(flow[p].values()), patterns[p])) if patterns[p] else (k, 0, 0) for k, p in keys.items()]
    ends = spark.createDataFrame(taken, "_key string, passes long, rest long")
    def end(of: DataFrame, number: str, known: DataFrame) -> DataFrame:
        """Where each pattern's running words, from ``start`` on, pass ``rest``: _key, rest, number, before."""
        running = F.sum("words").over(Window.partitionBy("_key").orderBy(number))
        joined = of.join(F.broadcast(known), "_key").withColumn("before", F.col("start") + running - F.col("words"))
        return joined.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")) & (F.col("rest") > 0)).select("_key", "rest", number, "before")

    # in two steps of 2**(BUCKET_BITS / 2) numbers each, so that no window holds all buckets of a pattern
    half = BUCKET_BITS // 2
    coarse = by_bucket.groupBy("_key", F.shiftright("_bucket", half).alias("_coarse")).agg(F.sum("words").alias("words"))
    first = spark.createDataFrame(end(coarse, "_coarse", ends.withColumn("start", F.lit(0))).collect(), "_key string, rest long, _coarse int, start long")
    fine = by_bucket.withColumn("_coarse", F.shiftright("_bucket", half)).join(F.broadcast(first.select("_key", "_coarse")), ["_key", "_coarse"], "left_semi")
    last = {r._key: (r._bucket, r.before) for r in end(fine.drop("_coarse"), "_bucket", first.drop("_coarse")).collect()}
    rows_of = [(k, passes, rest, *last.get(k, (-1, 0))) for k, passes, rest in taken]
    plan = spark.createDataFrame(rows_of, "_key string, passes long, rest long, last_bucket int, before long")
    return Mix(plan, keys, {s: (sizes[s], float(targets[s])) for s in order}, flow)


def select_documents(rows: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` with taken (words) and copies (whole documents); only the rows of the last buckets are shuffled."""
    joined = rows.join(F.broadcast(mix.patterns), "_key")
    more = (F.col("_bucket") < F.col("last_bucket")).cast("long")
    sure = joined.where(F.col("_bucket") != F.col("last_bucket")).withColumns({"taken": F.col("_size") * (F.col("passes") + more), "copies": F.col("passes") + more})
    order = Window.partitionBy("_key").orderBy("_hash", "_size").rowsBetween(Window.unboundedPreceding, -1)
    edge = joined.where(F.col("_bucket") == F.col("last_bucket"))
    at = F.col("before") + F.coalesce(F.sum("_size").over(order), F.lit(0))
    edge = edge.withColumn("_part", F.greatest(F.lit(0), F.least(F.col("_size"), F.col("rest") - at)))
    whole = ((F.col("_part") > 0) & (2 * F.col("_part") >= F.col("_size"))).cast("long")
    edge = edge.withColumns({"taken": F.col("_size") * F.col("passes") + F.col("_part"), "copies": F.col("passes") + whole}).drop("_part")
    return sure.unionByName(edge).drop("passes", "rest", "last_bucket", "before")


def whole_documents(rows: DataFrame, mix: Mix) -> DataFrame:
    """(_key, _hash) of the rows of the last buckets that one more pass takes: those of which it takes half the words or more."""
    edge = rows.join(F.broadcast(mix.patterns), "_key").where(F.col("_bucket") == F.col("last_bucket"))
    alike = edge.groupBy("_key", "_hash", "rest", "before").agg(F.sum("_size").alias("words")).where("words > 0")
    order = Window.partitionBy("_key").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
    part = F.least(F.col("words"), F.col("rest") - F.col("before") - F.coalesce(F.sum("words").over(order), F.lit(0)))
    return alike.withColumn("part", part).where("part > 0 and 2 * part >= words").select("_key", "_hash")


@scoped
def mix_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, seed: int = 20) -> DataFrame:
    """Words the mix takes of every document: id, size, source_size, target, taken, copies.

    ``source_col`` is a string or an array of strings (overlapping sources;
    source_size and target are then those of the first source). A null source,
    an empty array and a null in an array are one source of their own, last in
    order. A null text has size 0 and gives 0 words. Rows with equal ids are
    taken each on their own. Every source takes exactly its target, to the
    word, so one document of a pattern may be taken in part; ``copies`` rounds
    that part to whole documents. Extra columns are ignored; an empty table
    gives an empty table.
    """
    rows = marked(same_or_null(docs, id_col, text_col, source_col), id_col, text_col, source_col, seed).drop("row")
    mix = plan_mix(rows := materialise(rows, "sizes"), weights, limit)
    facts = [(key, *mix.sources[p[0]]) for key, p in mix.keys.items()]
    facts = docs.sparkSession.createDataFrame(facts, "_key string, source_size long, target double")
    out = select_documents(rows, mix).join(F.broadcast(facts), "_key")
    return out.select("id", F.col("_size").alias("size"), "source_size", "target", "taken", "copies")


@scoped
def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, seed: int = 20) -> DataFrame:
    """The mixed documents themselves, each row of ``docs`` as often as the mix takes it (0 to ``limit`` times), all columns kept.

    Words are counted once, at a first scan; the second only hashes the rows to
    look up what was decided, and shuffles no text as long as the rows of the
    last buckets (about one in 2**BUCKET_BITS) that are taken are few enough to
    be sent to it. Rows that are equal throughout are taken alike.
    """
    rows = marked(docs, id_col, text_col, source_col, seed)
    sizes = materialise(rows.select("_key", "_size", "_hash", "_bucket"), "sizes")
    mix = plan_mix(sizes, weights, limit)
    chosen = materialise(whole_documents(sizes, mix), "chosen")
    planned = rows.select("row", "_key", "_hash", "_bucket").join(F.broadcast(mix.patterns), "_key")
    more = F.col("_bucket") < F.col("last_bucket")
    if chosen.limit(MAX_CHOSEN + 1).count() <= MAX_CHOSEN:
        found = planned.join(F.broadcast(chosen.withColumn("_one", F.lit(True))), ["_key", "_hash"], "left")
    else:  # only rows of the last buckets meet the choices by key
        edge = F.col("_bucket") == F.col("last_bucket")
        found = planned.where(~edge).withColumn("_one", F.lit(False)).unionByName(planned.where(edge).join(chosen.withColumn("_one", F.lit(True)).hint("merge"), ["_key", "_hash"], "left"))
    more = more | F.coalesce("_one", F.lit(False))
    taken = found.select("row", (F.col("passes") + more.cast("int")).alias("copies")).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
