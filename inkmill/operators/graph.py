"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and two joins over the edge table, written to
the shared folder; nothing but a count and a checksum reaches the driver. Hubs
are reduced by partial aggregation, and a hub's edges are joined by a plain
equi-join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators.work import discard, materialise, scoped


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b")
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


@scoped
def connected_components(edges: DataFrame) -> DataFrame:
    """Label the nodes of an undirected graph.

    ``edges``: columns a, b (long). Loops, repeated edges, both directions and
    null ends are allowed; loops and rows with a null end are ignored. Returns
    (node, component) for every node of at least one remaining edge, where
    component is the smallest node reachable. An empty edge table gives an
    empty table.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    clean = edges.where("a is not null and b is not null and a <> b").select(low.alias("a"), high.alias("b")).distinct()
    now, mark = materialise(clean, "edges"), None
    while True:  # the stars' sums of labels fall with every round until they settle
        after = materialise(_small_star(_large_star(now)), "edges")
        n, checksum = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(now)
        now, before, mark = after, mark, (n, checksum)
        if mark == before:
            break
    roots = now.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("node"), "component")
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
