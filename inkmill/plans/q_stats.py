"""Frequencies, manifests, islands, nearest joins and rankings over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkmill.functions.boxes import audit_passed
from inkmill.functions.text import class_group, class_icon, parse_page_ranges, resolve_direction
from inkmill.operators import islands, manifest, stats, taxonomy
from inkmill.plans.registry import query, table


@query("select event_type, count(*) as n, count(*) / sum(count(*)) over () as share from events group by event_type")
def q01_frequency(spark, sf_dir):
    return stats.frequencies(table(spark, sf_dir, "events"), ["event_type"])


@query("select lang as grp, source as icon, count(*) as n from documents group by all")
def q02_group_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat_ws(".", "lang", "source").alias("name"))
    return docs.groupBy(class_group("name").alias("grp"), class_icon("name").alias("icon")).agg(F.count("*").alias("n"))


@query("select lang, source, count(*) as n, count(*) / sum(count(*)) over (partition by lang) as share from documents group by lang, source")
def q03_per_book(spark, sf_dir):
    return stats.frequencies(table(spark, sf_dir, "documents"), ["source"], within=["lang"])


@query("select lang, source, count(*) as n, grouping_id(lang, source) as gid from documents group by grouping sets ((lang), (source), (lang, source))")
def q04_grouping_sets(spark, sf_dir):
    return stats.grouping_frequencies(table(spark, sf_dir, "documents").select("lang", "source"), [["lang"], ["source"], ["lang", "source"]])


def _nearest_clicks(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    rows = events.where("event_type = 'purchase'").select("user_id", "event_id", "value", F.col("event_id").alias("y"))
    bases = events.where("event_type = 'click'").select("user_id", F.col("event_id").alias("base_id"), "value", F.col("event_id").alias("y"))
    return stats.nearest(rows, bases, ["user_id"], "event_id", "base_id", ["value", "y"])


_NEAREST = """
    with pairs as (
        select p.user_id, p.event_id, b.event_id as base_id, abs(p.value - b.value) + abs(p.event_id - b.event_id) as distance
        from events p join events b on p.user_id = b.user_id and p.event_type = 'purchase' and b.event_type = 'click'),
    best as (select *, row_number() over (partition by event_id order by distance, base_id) as r from pairs)
    select user_id, event_id, base_id, distance from best where r = 1"""


@query(_NEAREST)
def q05_nearest_base(spark, sf_dir):
    return _nearest_clicks(spark, sf_dir)


@query(f"""
    with near as ({_NEAREST}),
    named as (select floor(b.value / 50) as base, floor(e.value / 50) as modifier from near n join events b on b.event_id = n.base_id join events e on e.event_id = n.event_id)
    select cast(base as bigint) as base, cast(modifier as bigint) as modifier, count(*) as n, count(*) / sum(count(*)) over () as share from named group by base, modifier""")
def q06_cooccurrence(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    bin_of = events.select("event_id", F.floor(F.col("value") / 50).alias("bin"))
    near = _nearest_clicks(spark, sf_dir)
    named = near.join(bin_of.withColumnsRenamed({"event_id": "base_id", "bin": "base"}), "base_id").join(bin_of.withColumnRenamed("bin", "modifier"), "event_id")
    return stats.frequencies(named, ["base", "modifier"])


@query("select o_orderkey from orders p where o_orderpriority in ('1-URGENT', '2-HIGH') and not exists (select 1 from orders m where m.o_orderstatus = 'F' and m.o_orderkey = p.o_orderkey)")
def q07_resume_anti(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    planned = orders.where("o_orderpriority in ('1-URGENT', '2-HIGH')").select("o_orderkey")
    return manifest.pending(planned, orders.where("o_orderstatus = 'F'"), ["o_orderkey"])


@query("""
    with fresh as (select o_orderkey, o_totalprice * 2 as o_totalprice, 'new' as origin from orders where o_orderpriority = '1-URGENT')
    select o_orderkey, o_totalprice, 'old' as origin from orders o where o_orderstatus <> 'P' and not exists (select 1 from fresh f where f.o_orderkey = o.o_orderkey)
    union all select * from fresh""")
def q08_manifest_upsert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice", F.lit("old").alias("origin"))
    new = orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("new").alias("origin"))
    return manifest.upsert(old, new, ["o_orderkey"])


def _cheap(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_totalprice < 150000").select("o_orderstatus", "o_orderkey")


_RUNS = """
    select o_orderstatus, min(o_orderkey) as first, max(o_orderkey) as last
    from (select distinct o_orderstatus, o_orderkey, o_orderkey - dense_rank() over (partition by o_orderstatus order by o_orderkey) as g from orders where o_totalprice < 150000)
    group by o_orderstatus, g"""


@query(_RUNS)
def q09_runs(spark, sf_dir):
    return islands.contiguous_runs(_cheap(spark, sf_dir), "o_orderkey", ["o_orderstatus"])


@query(f"""
    select o_orderstatus, c as chunk_first, least(c + 1, last) as chunk_last
    from (select o_orderstatus, last, unnest(generate_series(first, last, 2)) as c from ({_RUNS}))""")
def q10_chunks(spark, sf_dir):
    return islands.chunk_runs(islands.contiguous_runs(_cheap(spark, sf_dir), "o_orderkey", ["o_orderstatus"]), 2).select("o_orderstatus", "chunk_first", "chunk_last")


_SPECS = [(1, "5-7,2,10-11"), (2, "3"), (3, "1-4, 2-6,6")]


@query("""
    with specs(spec_id, spec) as (values (1, '5-7,2,10-11'), (2, '3'), (3, '1-4, 2-6,6')),
    pieces as (select spec_id, trim(p) as p from (select spec_id, unnest(string_split(spec, ',')) as p from specs)),
    ends as (select spec_id, cast(split_part(p, '-', 1) as int) as lo, cast(case when contains(p, '-') then split_part(p, '-', 2) else p end as int) as hi from pieces)
    select distinct cast(spec_id as int) as spec_id, cast(unnest(generate_series(lo, hi)) as int) as page from ends""")
def q11_page_range(spark, sf_dir):
    return parse_page_ranges(spark.createDataFrame(_SPECS, "spec_id int, spec string")).select("spec_id", "page")


@query("""
    with hours as (select event_type, epoch_us(ts) // 3600000000 as hour, count(*) as n from events group by all),
    active as (select event_type, hour, hour - row_number() over (partition by event_type order by hour) as g from hours where n >= 3)
    select event_type, min(hour) as first, max(hour) + 1 as stop from active group by event_type, g having count(*) >= 2""")
def q12_row_bands(spark, sf_dir):
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000)
    hours = table(spark, sf_dir, "events").groupBy("event_type", hour.alias("hour")).agg(F.count("*").alias("n"))
    return islands.active_bands(hours, "hour", F.col("n") >= 3, ["event_type"], min_length=2)


@query("""
    with days as (select event_type, epoch_us(ts) // 86400000000 as day, count(*) as n from events group by all)
    select event_type, day, n from days
    qualify n = max(n) over (partition by event_type order by day rows between 2 preceding and 2 following)""")
def q21_local_max(spark, sf_dir):
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86_400_000_000)
    days = table(spark, sf_dir, "events").groupBy("event_type", day.alias("day")).agg(F.count("*").alias("n"))
    return islands.local_maxima(days, ["event_type"], "day", "n", 2)


#: Brand families of the fold query; a repeated member's last family wins.
_FAMILIES = [("Brand#1", "Brand#2", 0), ("Brand#3", "Brand#2", 1), ("Brand#4", "Brand#5", 2), ("Brand#1", "Brand#5", 3), ("Brand#98", "Brand#99", 4)]


@query("""
    with families(member, representative, ord) as (values ('Brand#1', 'Brand#2', 0), ('Brand#3', 'Brand#2', 1), ('Brand#4', 'Brand#5', 2), ('Brand#1', 'Brand#5', 3), ('Brand#98', 'Brand#99', 4)),
    last as (select member, arg_max(representative, ord) as representative from families group by member),
    known as (select distinct p_brand from part union select 'Brand#98'),
    counts as (select p_brand, count(*) as n from part group by p_brand),
    folded as (select coalesce(representative, k.p_brand) as family, cast(coalesce(sum(n), 0) as bigint) as n from known k left join counts c on c.p_brand = k.p_brand left join last on member = k.p_brand group by 1)
    select family, n, round(100.0 * n / sum(n) over (), 6) as pct, row_number() over (order by n desc, family) as rank from folded""")
def q28_family_fold(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    known = part.select("p_brand").union(spark.createDataFrame([("Brand#98",)], "p_brand string"))
    counts = part.groupBy("p_brand").agg(F.count("*").alias("n"))
    folded = stats.fold_families(counts, known, spark.createDataFrame(_FAMILIES, "member string, representative string, ord int"), "p_brand", "n")
    total = folded.agg(F.sum("n").alias("total"))
    shared = folded.crossJoin(F.broadcast(total)).select("family", "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 6).alias("pct"))
    return stats.ranked(shared, [F.desc("n"), F.asc("family")]).withColumn("rank", F.col("rank").cast("long"))


@query("""
    select conv_id, coalesce(arg_max(turn, turn) filter (role <> 'system'), max(turn)) as turn,
           coalesce(arg_max(role, turn) filter (role <> 'system'), arg_max(role, turn)) as role,
           coalesce(arg_max(text, turn) filter (role <> 'system'), arg_max(text, turn)) as text
    from conversations group by conv_id""")
def q33_latest_annotation(spark, sf_dir):
    return stats.latest_valid(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), ["conv_id"], "turn", F.col("role") != "system")


#: Directions by region number (as book) and nation number (as page).
_DIRECTIONS = [("0", "default", "rtl"), ("0", "5", "ltr"), ("1", "page_0002", "rtl"), ("1", "3", "rtl"), ("2", "8", "rtl"), ("2", "page_0008", "ltr")]


@query("""
    with d(book, key, direction) as (values ('0', 'default', 'rtl'), ('0', '5', 'ltr'), ('1', 'page_0002', 'rtl'), ('1', '3', 'rtl'), ('2', '8', 'rtl'), ('2', 'page_0008', 'ltr'))
    select n_nationkey, coalesce(a.direction, b.direction, c.direction, 'ltr') as direction from nation
    left join d a on a.book = cast(n_regionkey as varchar) and a.key = cast(n_nationkey as varchar)
    left join d b on b.book = cast(n_regionkey as varchar) and b.key = printf('page_%04d', n_nationkey)
    left join d c on c.book = cast(n_regionkey as varchar) and c.key = 'default'""")
def q36_direction_resolve(spark, sf_dir):
    pages = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").cast("string").alias("book_id"))
    return resolve_direction(pages, spark.createDataFrame(_DIRECTIONS, "book string, key string, direction string"), "ltr", "book_id", "n_nationkey").select("n_nationkey", "direction")


def _audited(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "content").otherwise("blank").alias("expected"))
    ratio = F.length(F.regexp_replace("text", "[^A-Za-z]", "")) / F.length("text")
    rows = docs.withColumn("ratio", ratio).join(labels, "doc_id")
    return rows.select("doc_id", "expected", F.round("ratio", 6).alias("ratio"), audit_passed("expected", "ratio", 0.7, 0.69).alias("passed"))


_AUDITED = """
    with rows as (select doc_id, case when quality = 1 then 'content' else 'blank' end as expected, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / length(text) as r from documents join labels using (doc_id))
    select doc_id, expected, round(r, 6) as ratio, case when expected = 'content' then r >= 0.7 else r <= 0.69 end as passed from rows"""


@query(_AUDITED)
def q37_audit(spark, sf_dir):
    return _audited(spark, sf_dir)


@query(f"select coalesce(avg(cast(passed as double)), 0) as precision from ({_AUDITED})")
def q38_precision(spark, sf_dir):
    return stats.precision(_audited(spark, sf_dir), "passed")


#: Limits by part type.
_LIMITS = [("PROMO", 0.65, 35), ("SMALL", 0.75, 40), ("LARGE", 0.78, 5)]


@query("""
    with limits(icon, threshold, priority) as (values ('PROMO', 0.65, 35), ('SMALL', 0.75, 40), ('LARGE', 0.78, 5))
    select group_id, cast(coalesce(min(threshold), 0.75) as double) as threshold, cast(coalesce(max(priority), 10) as int) as priority
    from (select distinct p_brand || ' ' || p_size as group_id, p_type from part) left join limits on icon = p_type group by group_id""")
def q39_threshold_priority(spark, sf_dir):
    groups = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_brand", "p_size").alias("group_id"), F.col("p_type").alias("icon")).distinct()
    return stats.group_limits(groups, spark.createDataFrame(_LIMITS, "icon string, threshold double, priority int"), 0.75, 10)


@query("""
    with symbols as (
        select 0 as part, r_regionkey as k, 'gorgon' as grp, r_name as icon from region
        union all select 1, n_nationkey, case when n_name like 'I%' then 'rest' else 'neume' end, n_name from nation
        union all select 2, p_partkey, 'mode', p_type from part),
    named as (select part * 1000000000 + k as pos, grp, case when grp = 'neume' then 'base_neume' when grp = 'gorgon' then 'modifier_gorgon' else grp end || '.' || icon as name from symbols),
    once as (select name, min(pos) as spot, arg_min(grp, pos) as grp from named group by name)
    select cast(row_number() over (order by spot, name) - 1 as int) as class_id, name, grp as "group" from once""")
def q40_taxonomy(spark, sf_dir):
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").cast("long").alias("k"), F.col("r_name").alias("icon"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("icon"))
    types = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_type").alias("icon"))
    union = taxonomy.tagged_union([("gorgon", region), ("neume", nation), ("mode", types)])
    group = F.when((F.col("grp") == "neume") & F.col("icon").startswith("I"), "rest").otherwise(F.col("grp"))
    return taxonomy.class_list(union.select((F.col("part") * 1_000_000_000 + F.col("k")).alias("pos"), group.alias("group"), "icon"))


@query("""
    with m as (select distinct p_type || ' ' || p_size as icon, p_brand as grp from part)
    select icon, count(*) as n from m where icon <> 'PROMO 7' group by icon having count(*) <> 1""")
def q41_membership(spark, sf_dir):
    members = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_type", "p_size").alias("icon"), F.col("p_brand").alias("grp")).distinct()
    return taxonomy.misplaced(members, spark.createDataFrame([("PROMO 7",)], "icon string"))


@query("""
    with a as (select s_suppkey, s_name, s_acctbal from supplier where s_nationkey <> 3),
    b as (select s_suppkey, s_name, case when s_acctbal < 0 then null else s_acctbal end as s_acctbal from supplier where s_nationkey <> 7)
    select s_suppkey, case when b.s_name is null then 'removed' when a.s_name is null then 'added' else 'changed' end as change
    from a full join b using (s_suppkey) where a.s_name is distinct from b.s_name or a.s_acctbal is distinct from b.s_acctbal""")
def q42_drift(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    old = supplier.where("s_nationkey <> 3").select("s_suppkey", "s_name", "s_acctbal")
    new = supplier.where("s_nationkey <> 7").select("s_suppkey", "s_name", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("s_acctbal"))
    return taxonomy.drift(old, new, ["s_suppkey"])


@query("select doc_id, lang from documents order by md5('42' || doc_id), doc_id limit 100")
def q43_sample(spark, sf_dir):
    return stats.seeded_sample(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 100, "42")


@query("select source, doc_id, n_chars from documents qualify row_number() over (partition by source order by n_chars desc, doc_id) <= 5")
def q44_head_per_book(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return stats.head_per_key(docs, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 5)


@query("select user_id, count(*) as n from events group by user_id order by n desc, user_id limit 40")
def q45_topk(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(40)


@query("""
    select user_id as page, count(*) as detections, count(*) filter (event_type = 'error') as empty_groups, cast(coalesce(avg(round(value, 2)), 0) as double) > 50 as sure
    from events group by user_id""")
def q51_page_metrics(spark, sf_dir):
    """AGG14, AGG18, AGG19: per-page metrics from nested detections.

    Sums of doubles depend on their order, so a page's detections are taken in
    the order of their ids. Values round as value * 100 does; nulls have no
    part in the mean, which is 0 without values.
    """
    item = F.struct("event_id", "event_type", "value")
    pages = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("page")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    empty = F.size(F.filter("items", lambda x: x["event_type"] == "error")).cast("long")
    values = F.filter(F.transform("items", lambda x: F.round(x["value"] * 100) / 100), lambda x: x.isNotNull())
    mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x, lambda s: s / F.nullif(F.size(values), F.lit(0)))
    return pages.select("page", F.size("items").cast("long").alias("detections"), empty.alias("empty_groups"), (F.coalesce(mean, F.lit(0.0)) > 50).alias("sure"))
