"""Frequencies, nearest joins, folds into families, rankings (AGG1-AGG9, AGG13-19, JN3-6, WIN5, WIN7-14, SET5)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.operators.work import broadcast_if_small


def frequencies(df: DataFrame, keys: list[str], within: list[str] | None = None, count: str = "n", share: str = "share") -> DataFrame:
    """AGG1-AGG3: rows per key and their share of all rows, or of the rows with the same ``within`` keys.

    The share's total comes from the counts, not from the rows.
    """
    counts = df.groupBy(*dict.fromkeys([*(within or []), *keys])).agg(F.count("*").alias(count))
    if within:
        return counts.withColumn(share, F.col(count) / F.sum(count).over(Window.partitionBy(*within)))
    total = counts.agg(F.sum(count).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).withColumn(share, F.col(count) / F.col("_total")).drop("_total")


def grouping_frequencies(df: DataFrame, sets: list[list[str]], count: str = "n") -> DataFrame:
    """AGG1-AGG3 in one pass: counts for several key sets, with ``gid`` telling which keys are summed over."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    view = f"grouping_{abs(hash(df))}"
    df.createOrReplaceTempView(view)
    listed = ", ".join("(" + ", ".join(s) + ")" for s in sets)
    return df.sparkSession.sql(f"select {', '.join(keys)}, count(*) as {count}, grouping_id({', '.join(keys)}) as gid from {view} group by grouping sets ({listed})")


def nearest(rows: DataFrame, bases: DataFrame, page: list[str], row_id: str, base_id: str, coords: list[str], block_rows: int = 50_000, pair_limit: int = 5_000_000) -> DataFrame:
    """JN6: each row's nearest base of the same page by L1 distance, ties to the smallest base id: page, row id, base id, distance.

    Both tables have the ``coords`` columns, without nulls; ids are whole
    numbers; rows of pages without a base go. Pages are counted first: those
    with at most ``pair_limit`` pairs of a row and a base are joined and keep
    the least pair, partly before the shuffle; in those with more, no pair is
    ever a row (``_nearest_in_blocks``).
    """
    counts = rows.groupBy(*page).agg(F.count("*").alias("_n")).join(bases.groupBy(*page).agg(F.count("*").alias("_m")), page)
    hot = counts.where(F.col("_n") * F.col("_m") > pair_limit).select(*page)
    listed = hot.limit(10_001).collect()
    if len(listed) > 10_000:
        return _nearest_in_blocks(rows, bases, page, row_id, base_id, coords, block_rows)
    apart, few = [], (rows, bases)
    if listed:
        at = F.broadcast(rows.sparkSession.createDataFrame(listed, hot.schema))
        few = tuple(df.join(at, page, "left_anti") for df in (rows, bases))
        apart = [_nearest_in_blocks(*(df.join(at, page, "left_semi") for df in (rows, bases)), page, row_id, base_id, coords, block_rows)]
    point = [F.col(c).cast("double") for c in coords]
    left = few[0].select(*page, F.col(row_id), *[p.alias(f"_a{k}") for k, p in enumerate(point)])
    right = few[1].select(*page, F.col(base_id), *[p.alias(f"_b{k}") for k, p in enumerate(point)])
    distance = sum((F.abs(F.col(f"_a{k}") - F.col(f"_b{k}")) for k in range(1, len(coords))), F.abs(F.col("_a0") - F.col("_b0")))
    best = left.join(right, page).groupBy(*page, row_id).agg(F.min(F.struct(distance.alias("d"), F.col(base_id).alias("b"))).alias("_best"))
    found = best.select(*page, row_id, F.col("_best.b").alias(base_id), F.col("_best.d").alias("distance"))
    return found.unionByName(apart[0]) if apart else found


def _nearest_in_blocks(rows: DataFrame, bases: DataFrame, page: list[str], row_id: str, base_id: str, coords: list[str], block_rows: int) -> DataFrame:
    """The same by arrays: a page's rows and bases are cut into parts of about ``block_rows``, each pair of parts meets in one task, and the best of a row's parts is taken."""
    parts, blocks = (df.groupBy(*page).agg(F.ceil(F.count("*") / block_rows).cast("int").alias(c)) for df, c in ((rows, "_parts"), (bases, "_blocks")))
    grid = parts.join(blocks, page)
    point = [F.col(c).cast("double").alias(c) for c in coords]

    def dealt(df: DataFrame, which: str, own: tuple[str, str], other: tuple[str, str], side: int) -> DataFrame:
        placed = df.select(*page, F.col(which).cast("long").alias("_id"), *point).join(grid, page)
        placed = placed.withColumn(own[0], F.pmod(F.xxhash64("_id"), F.col(own[1])).cast("int")).withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1)))
        return placed.select(*page, "_part", "_block", F.lit(side).alias("_side"), "_id", *coords)

    by_rows, by_bases = ("_part", "_parts"), ("_block", "_blocks")
    both = dealt(rows, row_id, by_rows, by_bases, 1).unionByName(dealt(bases, base_id, by_bases, by_rows, 0))
    n = len(page)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, points, ready = None, [], [], None
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(n + 2)), strict=True))
            side, own = batch.column(n + 2).to_pylist(), batch.column(n + 3).to_pylist()
            place = np.column_stack([batch.column(n + 4 + k).to_numpy(zero_copy_only=False) for k in range(len(coords))]) if keys else np.empty((0, len(coords)))
            found, far = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
            has, at = np.zeros(len(keys), bool), 0
            while at < len(keys):
                if keys[at] != key:
                    key, ids, points, ready = keys[at], [], [], None
                stop = at + 1
                while stop < len(keys) and keys[stop] == key and side[stop] == side[at]:
                    stop += 1
                if side[at] == 0:
                    ids += own[at:stop]
                    points.append(place[at:stop])
                elif ids:
                    ready = (np.array(ids), np.concatenate(points)) if ready is None else ready
                    step = max(1, 2_000_000 // len(ids))
                    for k in range(at, stop, step):
                        end = min(stop, k + step)
                        d = sum(np.abs(place[k:end, c, None] - ready[1][None, :, c]) for c in range(len(coords)))
                        best = d.argmin(axis=1)
                        found[k:end], far[k:end], has[k:end] = ready[0][best], d[np.arange(end - k), best], True
                at = stop
            out = [*batch.columns[:n], batch.column(n + 3), pa.array(found), pa.array(far)]
            yield pa.RecordBatch.from_arrays(out, [*page, row_id, base_id, "distance"]).filter(pa.array(has))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([*[f"`{p}` {kinds[p]}" for p in page], f"`{row_id}` long, `{base_id}` long, distance double"])
    order = [*page, "_part", "_block"]
    found = both.repartition(*order).sortWithinPartitions(*order, "_side", "_id").mapInArrow(run, schema)
    best = found.groupBy(*page, row_id).agg(F.min(F.struct(F.col("distance").alias("d"), F.col(base_id).alias("b"))).alias("_best"))
    out = best.select(*page, row_id, F.col("_best.b").alias(base_id), F.col("_best.d").alias("distance"))
    return out.withColumns({row_id: F.col(row_id).cast(kinds[row_id]), base_id: F.col(base_id).cast(bases.schema[base_id].dataType)})


def fold_families(counts: DataFrame, known: DataFrame, families: DataFrame, key: str, count: str) -> DataFrame:
    """JN5: counts summed by family representative; every known key appears, with 0 if uncounted, and no other.

    ``families``: member, representative, ord; of a key's families the last one wins.
    """
    last = families.groupBy("member").agg(F.max_by("representative", "ord").alias("representative"))
    joined = known.select(key).distinct().join(counts, key, "left").join(last, F.col(key) == last["member"], "left")
    return joined.groupBy(F.coalesce("representative", key).alias("family")).agg(F.coalesce(F.sum(count), F.lit(0)).alias(count))


def ranked(df: DataFrame, order: list[Column], rank: str = "rank", keys: list[str] | None = None) -> DataFrame:
    """WIN5: 1, 2, ... in ``order``; without keys this is for result tables, whose rows are few."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*(keys or [])).orderBy(*order)))


def head_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """WIN9: the first n rows of each key; the limit is applied before the shuffle as well."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def seeded_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """WIN13, SRC7: n rows without replacement, the same on every run: those with the least seeded MD5 of their key."""
    return df.withColumn("_h", F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))).orderBy("_h", key).limit(n).drop("_h")


def precision(df: DataFrame, passed: str) -> DataFrame:
    """AGG9: the share of passed rows, 0 without rows."""
    return df.agg(F.coalesce(F.avg(F.col(passed).cast("double")), F.lit(0.0)).alias("precision"))


def ordered_distinct(df: DataFrame, keys: list[str], order: Column, value: str, out: str) -> DataFrame:
    """SET5: each key's values once, in the order of their first appearance."""
    first = df.groupBy(*keys, value).agg(F.min(order).alias("_at"))
    items = F.array_sort(F.collect_list(F.struct("_at", value)))
    return first.groupBy(*keys).agg(F.transform(items, lambda x: x[value]).alias(out))


def latest_valid(df: DataFrame, keys: list[str], order: str, valid: Column) -> DataFrame:
    """WIN12: each key's last valid row, or its last row if none is valid."""
    row = F.struct(*df.columns)
    pick = F.coalesce(F.max_by(F.when(valid, row), F.when(valid, F.col(order))), F.max_by(row, order))
    return df.groupBy(*keys).agg(pick.alias("_row")).select("_row.*")


def group_limits(groups: DataFrame, limits: DataFrame, default_threshold: float, default_priority: int) -> DataFrame:
    """AGG15, AGG16: each group's least threshold and greatest priority over its named icons, else the defaults.

    ``groups``: group_id, icon. ``limits``: icon, threshold, priority.
    """
    joined = groups.join(broadcast_if_small(limits), "icon", "left")
    return joined.groupBy("group_id").agg(F.coalesce(F.min("threshold"), F.lit(default_threshold)).alias("threshold"), F.coalesce(F.max("priority"), F.lit(default_priority)).alias("priority"))


def largest_sizes(variants: DataFrame, names: list[str]) -> DataFrame:
    """FLT15: groups that carry one of ``names`` keep only their largest size; others keep all. ``variants``: group_id, icons, pt."""
    top = F.max("pt").over(Window.partitionBy("group_id"))
    named = F.arrays_overlap("icons", F.array(*map(F.lit, names)))
    return variants.withColumn("_top", top).where(~named | (F.col("pt") == F.col("_top"))).drop("_top")


def template_members(groups: DataFrame, name: str) -> DataFrame:
    """FLT16: a group that carries ``name`` is matched by its representative alone. ``groups``: id, representative, members, icons."""
    return groups.withColumn("members", F.when(F.array_contains("icons", name), F.array("representative")).otherwise(F.col("members")))
