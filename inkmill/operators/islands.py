"""Runs of consecutive numbers, chunks of runs, and bands of active positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contiguous_runs(df: DataFrame, number: str, keys: list[str] | None = None, block: int = 65_536) -> DataFrame:
    """Maximal runs of consecutive distinct integers per key: keys, first, last.

    Runs are found within blocks of ``block`` numbers, and those that touch a
    block's edge (two a block at most) are then stitched, so a key of any
    length is never sorted in one task. Null numbers are left out.
    """
    keys = keys or []
    at = F.col(number).cast("long")
    once = df.select(*keys, at.alias("n")).where("n is not null").distinct()
    blocked = once.withColumn("block", F.floor(F.col("n") / block))
    order = Window.partitionBy(*keys, "block").orderBy("n")
    local = blocked.withColumn("g", F.col("n") - F.row_number().over(order)).groupBy(*keys, "block", "g").agg(F.min("n").alias("first"), F.max("n").alias("last"))
    edge = (F.col("first") == F.col("block") * block) | (F.col("last") == (F.col("block") + 1) * block - 1)
    inner = local.where(~edge).select(*keys, "first", "last")
    over = Window.partitionBy(*keys).orderBy("first")
    new = (F.col("first") != F.lag("last").over(over) + 1) | F.lag("last").over(over).isNull()
    edges = local.where(edge).select(*keys, "first", "last").withColumn("new", new.cast("int"))
    edges = edges.withColumn("run", F.sum("new").over(over)).groupBy(*keys, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return inner.unionByName(edges.select(*keys, "first", "last"))


def chunk_runs(runs: DataFrame, size: int) -> DataFrame:
    """Split every run into inclusive chunks of at most ``size`` numbers."""
    if size < 1:
        raise ValueError("chunks hold at least one number")
    starts = runs.withColumn("chunk_first", F.explode(F.sequence("first", "last", F.lit(size).cast("long"))))
    return starts.withColumn("chunk_last", F.least(F.col("chunk_first") + size - 1, F.col("last")))


def active_bands(df: DataFrame, position: str, active: Column, keys: list[str] | None = None, min_length: int = 1) -> DataFrame:
    """Half-open bands [first, stop) of consecutive active positions, at least ``min_length`` long."""
    runs = contiguous_runs(df.where(active), position, keys)
    return runs.withColumn("stop", F.col("last") + 1).where(F.col("stop") - F.col("first") >= min_length).drop("last")


def local_maxima(df: DataFrame, keys: list[str], position: str, value: str, radius: int) -> DataFrame:
    """Rows whose value is the largest within ``radius`` rows on either side; all rows of a plateau stay."""
    near = Window.partitionBy(*keys).orderBy(position).rowsBetween(-radius, radius)
    return df.withColumn("_top", F.max(value).over(near)).where(F.col(value) == F.col("_top")).drop("_top")
