"""Collapse of cumulative conversation snapshots, and chat rendering.

A logged conversation that is the start of a longer one, or a copy of another,
adds nothing. Every turn's hash is salted with its position, and the XOR of a
conversation's first k turn hashes (two independent ones, 128 bits) names its
prefix of length k. Prefixes that do not end a conversation, once each, are
anti-joined against whole conversations; what stays is maximal. Positions and
running hashes are taken within blocks of turns first and then over the
blocks' totals, so that one long conversation does not fill one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.llm.work import materialise, scoped

#: Turns a block holds by number; rendered text comes in segments of as many.
BLOCK_TURNS = 256
_MISSING = "\x00missing"


def _turn_rows(turns: DataFrame, conv: str, turn: str, role: str, text: str, block_turns: int) -> DataFrame:
    parts = [F.coalesce(F.col(f"`{c}`"), F.lit(_MISSING)) for c in (role, text)]
    number = F.col(f"`{turn}`").cast("long")
    return turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"),
        number.alias("turn"),
        F.coalesce(F.floor(number / block_turns), F.lit(1 << 60)).alias("block"),
        F.xxhash64(F.lit(1), *parts).alias("h1"),
        F.xxhash64(F.lit(2), *parts).alias("h2"),
        F.col(f"`{role}`").alias("role"),
        F.col(f"`{text}`").alias("text"),
    )


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_last(), F.col("h1"), F.col("h2")]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, position, p1, p2, n_turns) of every prefix. ``turns``: conv, turn, block, h1, h2, no row twice."""
    inside = Window.partitionBy("conv", "block").orderBy(*_order())
    local = turns.withColumn("k", F.row_number().over(inside))
    blocks = turns.groupBy("conv", "block").agg(F.count("*").alias("size"))
    over = Window.partitionBy("conv").orderBy("block")
    before = blocks.select("conv", "block", F.coalesce(F.sum("size").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = local.join(before, ["conv", "block"]).withColumn("position", F.col("base") + F.col("k"))
    placed = placed.withColumns({f"s{i}": F.xxhash64(F.lit(i), "position", f"h{i}") for i in (1, 2)})
    running = Window.partitionBy("conv", "block").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumns({f"x{i}": F.bit_xor(f"s{i}").over(running) for i in (1, 2)}).select("conv", "block", "position", "x1", "x2")
    totals = placed.groupBy("conv", "block").agg(F.max("position").alias("last"), F.max_by("x1", "position").alias("x1"), F.max_by("x2", "position").alias("x2"))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv")
    totals = totals.select("conv", "block", F.max("last").over(whole).alias("n_turns"), *[F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0)).alias(f"b{i}") for i in (1, 2)])
    joined = placed.join(totals, ["conv", "block"])
    return joined.select("conv", "position", F.col("x1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("b2")).alias("p2"), "n_turns")


@scoped
def collapse(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Fate of every conversation: conv, n_turns, kept, reason (maximal, prefix, or copy).

    Turns go by number, null numbers last, equal numbers by their hash; a row
    that repeats another's conversation, number, role and text counts once.
    Null roles and texts are values of their own. Rows with a null conversation
    belong to none and are left out. Of equal conversations the smallest id is
    kept. Extra columns are ignored; an empty table gives an empty table.
    """
    rows = _turn_rows(turns, conv_col, turn_col, role_col, text_col, block_turns).select("conv", "turn", "block", "h1", "h2").distinct()
    every = materialise(prefixes(rows), "prefixes")
    ends = every.where("position = n_turns").select("conv", "n_turns", "p1", "p2")
    inner = every.where("position < n_turns").select(F.col("position").alias("n_turns"), "p1", "p2").distinct().withColumn("inner", F.lit(True))
    first = ends.groupBy("n_turns", "p1", "p2").agg(F.min("conv").alias("first")).join(inner, ["n_turns", "p1", "p2"], "left")
    fate = ends.join(first, ["n_turns", "p1", "p2"])
    reason = F.when(F.col("inner"), "prefix").when(F.col("conv") != F.col("first"), "copy").otherwise("maximal")
    return fate.select("conv", "n_turns", (reason == "maximal").alias("kept"), reason.alias("reason"))


def _safe(text: Column) -> Column:
    """No text can open a marker of its own."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def render(turns: DataFrame, kept: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Chat text of the conversations in ``kept`` (column conv), in segments of consecutive turns.

    Returns conv, segment (from 0), turns, rendered. Each turn reads
    ``<|role|>``, a line end, the text, ``<|end|>``, a line end; ``<|`` within
    a role or text becomes ``< |``; a null role is ``unknown``, a null text is
    empty. Segments of a conversation, joined in order, are the whole.
    """
    rows = _turn_rows(turns, conv_col, turn_col, role_col, text_col, block_turns).join(kept.select("conv"), "conv", "left_semi")
    piece = F.concat(F.lit("<|"), _safe(F.coalesce("role", F.lit("unknown"))), F.lit("|>\n"), _safe(F.coalesce("text", F.lit(""))), F.lit("<|end|>\n"))
    items = F.array_sort(F.collect_set(F.struct(F.col("turn").isNull().alias("z"), "turn", "h1", "h2", piece.alias("piece"))))
    segments = rows.groupBy("conv", "block").agg(items.alias("items"))
    number = F.row_number().over(Window.partitionBy("conv").orderBy("block")) - 1
    sizes = segments.select("conv", "block", F.size("items").alias("turns"), F.array_join(F.transform("items", lambda x: x["piece"]), "").alias("rendered"))
    return sizes.select("conv", number.alias("segment"), "turns", "rendered")


@scoped
def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Collapse snapshots, then render what stays; edge cases as in ``collapse`` and ``render``."""
    columns = (conv_col, turn_col, role_col, text_col, block_turns)
    return render(turns, collapse(turns, *columns).where("kept"), *columns)
