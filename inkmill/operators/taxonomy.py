"""Symbol tables and class lists (SRC11-15, SRC25, PRJ12-15, AGG17, SET1, SET3-4, FLT17)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.text import class_name


def tagged_union(parts: list[tuple[str, DataFrame]], tag: str = "grp") -> DataFrame:
    """SET1: the bag union of several tables, each tagged, with ``part`` giving their order."""
    frames = [df.withColumns({tag: F.lit(name), "part": F.lit(k)}) for k, (name, df) in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def primary_insert(variants: str = "variants") -> Column:
    """PRJ14: the first of insert, short, long, extraShort, under that a symbol has."""
    return F.coalesce(*[F.col(variants)[k] for k in ("insert", "short", "long", "extraShort", "under")])


def first_text(values: Column) -> Column:
    """PRJ14: the first non-empty text of an array."""
    return F.try_element_at(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(1))


def symbol_group(group: str, icon: str) -> Column:
    """PRJ14: neumes whose icon is a rest sign belong to the rests."""
    return F.when((F.col(group) == "neume") & F.col(icon).startswith("Siopi"), "rest").otherwise(F.col(group))


def symbol_role(group) -> Column:
    """PRJ14: what part a group plays in a composition."""
    g = F.col(group) if isinstance(group, str) else group
    return F.when(g == "neume", "base").when(g.isin("mode", "key_signature"), "key_signature").when(g.isin("rest", "ornament"), g).otherwise("modifier")


def build_symbols(toolbars: DataFrame, keys: DataFrame, actions: DataFrame) -> DataFrame:
    """SRC25, PRJ14: the symbol table from toolbar items, key signatures and action characters.

    ``toolbars``: grp, pos, icon, variants (map). ``keys``: pos, icon, label,
    insert, key_id, key_role, category, base_pitch. ``actions``: icon, chars
    (array). Toolbar symbols come first, then key signatures.
    """
    chars = actions.select("icon", first_text(F.col("chars")).alias("chars"))
    bar = toolbars.select(F.struct(F.lit(0).alias("s"), "pos").alias("at"), "icon", F.col("icon").alias("label"), symbol_group("grp", "icon").alias("group"), "variants", primary_insert().alias("insert"), F.when(F.col("grp") == "mode", "segmentStart").alias("key_role"))
    sign = keys.select(F.struct(F.lit(1).alias("s"), "pos").alias("at"), "icon", "label", F.lit("key_signature").alias("group"), F.create_map(F.lit("insert"), "insert").alias("variants"), "insert", "key_role", "key_id", "category", "base_pitch")
    both = bar.unionByName(sign, allowMissingColumns=True).withColumn("role", symbol_role("group"))
    return both.join(chars, "icon", "left").withColumn("pos", F.row_number().over(Window.orderBy("at")) - 1).drop("at")


def misplaced(memberships: DataFrame, exempt: DataFrame) -> DataFrame:
    """PRJ15: icons in none or several toolbars, key signatures excepted: icon, n. ``memberships``: icon, grp."""
    return memberships.groupBy("icon").agg(F.count("*").alias("n")).where("n <> 1").join(exempt.select("icon").distinct(), "icon", "left_anti")


def orphans(actions: DataFrame, represented: DataFrame) -> DataFrame:
    """FLT17, AGG17, SET3: action icons that no symbol represents."""
    return actions.select("icon").distinct().join(represented.select("icon").distinct(), "icon", "left_anti")


def class_list(symbols: DataFrame, order: str = "pos") -> DataFrame:
    """PRJ12, PRJ13: distinct class names by first appearance: class_id from 0, name, group.

    The distinct names are the result, so numbering them in one window is bounded by it.
    """
    named = symbols.withColumn("name", class_name("group", "icon"))
    once = named.groupBy("name").agg(F.min(order).alias("_at"), F.min_by("group", order).alias("group"))
    return once.select((F.row_number().over(Window.orderBy("_at", "name")) - 1).alias("class_id"), "name", "group")


def insert_by_icon(symbols: DataFrame) -> DataFrame:
    """SRC12: each icon's first non-empty insert. ``symbols``: pos, icon, insert."""
    return symbols.where("insert <> ''").groupBy("icon").agg(F.min_by("insert", "pos").alias("insert"))


def icons_by_codepoint(symbols: DataFrame) -> DataFrame:
    """SRC13: ordered distinct icons of every code point: cp, icons; SRC14 is their first: first_icon."""
    chars = symbols.where("insert <> ''").select("pos", "icon", F.posexplode(F.split("insert", "")).alias("k", "ch")).where("ch <> ''")
    seen = chars.groupBy(F.expr("ascii(ch)").alias("cp"), "icon").agg(F.min(F.struct("pos", "k")).alias("at"))
    items = F.array_sort(F.collect_list(F.struct("at", "icon")))
    listed = seen.groupBy("cp").agg(F.transform(items, lambda x: x["icon"]).alias("icons"))
    return listed.withColumn("first_icon", F.element_at("icons", 1))


def drift(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """SET4: rows that differ between two versions: keys, change (added, removed or changed); nulls compare as equal."""
    values = [c for c in expected.columns if c not in keys]
    a = expected.select(*keys, F.struct(*values).alias("_a"), F.lit(1).alias("_in_a"))
    b = actual.select(*keys, F.struct(*values).alias("_b"), F.lit(1).alias("_in_b"))
    both = a.join(b, keys, "full_outer")
    change = F.when(F.col("_in_b").isNull(), "removed").when(F.col("_in_a").isNull(), "added").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return both.select(*keys, change.alias("change")).where("change is not null")


def integrity(symbols: DataFrame, actions: DataFrame) -> DataFrame:
    """What a symbol table breaks: check, icon, detail.

    A character may stand once per group and variant; what key signatures
    insert must be known characters; every action icon needs a symbol.
    ``symbols``: icon, group, insert, variants; ``actions``: icon, chars.
    """
    chars = symbols.select("icon", "group", F.explode("variants").alias("variant", "ch")).where("ch <> ''")
    twice = chars.groupBy("group", "variant", "ch").agg(F.count("*").alias("n"), F.min("icon").alias("icon")).where("n > 1").select(F.lit("repeated").alias("check"), "icon", F.concat_ws(" ", "group", "variant", "ch").alias("detail"))
    known = chars.select(F.explode(F.split("ch", "")).alias("c")).union(actions.select(F.explode("chars").alias("c")).select(F.explode(F.split("c", "")))).distinct()
    keys = symbols.where("group = 'key_signature' and insert <> ''").select("icon", F.explode(F.split("insert", "")).alias("c"))
    unknown = keys.join(known, "c", "left_anti").select(F.lit("unknown insert").alias("check"), "icon", F.col("c").alias("detail"))
    lost = orphans(actions, symbols).select(F.lit("orphan").alias("check"), "icon", F.lit("").alias("detail"))
    return twice.unionByName(unknown).unionByName(lost)
