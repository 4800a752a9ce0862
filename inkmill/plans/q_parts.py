"""Predicates, lookups and small plans of the page tools, each over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkmill.functions.boxes import centre, is_modifier, is_probable_row, padded, template_fits
from inkmill.functions.text import checked_direction, in_ranges, is_blank_page, page_path, pages_from_bounds, parse_ranges
from inkmill.operators import folds, manifest, matching, shapes, stats, taxonomy
from inkmill.plans.q_boxes import _BOXES, _boxes
from inkmill.plans.q_text import codepoint_counts
from inkmill.plans.registry import query, table
from inkmill.sources import files, sinks


@query("""
    select o_orderkey, format('data/{}/page_{:04d}.png', o_orderstatus, o_orderkey) as path, case when o_orderkey % 3 = 0 then 'rtl' else 'ltr' end as direction,
           array_to_string(range(case o_custkey % 5 when 0 then 1 else o_custkey % 5 end, least(case o_orderkey % 7 when 0 then o_custkey % 9 else o_orderkey % 7 end, o_custkey % 9) + 1), ',') as pages
    from orders""")
def q61_page_plans(spark, sf_dir):
    """PRJ1, PRJ4, PRJ28: page paths, checked directions, and pages within bounds."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    pages = pages_from_bounds((customer % 5).cast("int"), (key % 7).cast("int"), (customer % 9).cast("int"))
    direction = checked_direction(F.when(key % 3 == 0, "RTL").otherwise("Ltr"))
    return table(spark, sf_dir, "orders").select("o_orderkey", page_path("data", "o_orderstatus", "o_orderkey").alias("path"), direction.alias("direction"), F.array_join(pages, ",").alias("pages"))


#: Ranges as a user may write them, and what they mean.
_SPECS = {"41-5a": (0x41, 0x5A), "e9": (0xE9, 0xE9), " U+20-U+7E ": (0x20, 0x7E), "0x112-174": (0x112, 0x174)}
_SPEC_ROWS = ", ".join(f"('{s}', {lo}, {hi})" for s, (lo, hi) in _SPECS.items())


@query(f"""
    with specs(spec, lo, hi) as (values {_SPEC_ROWS}),
    counts as (select unicode(c) as cp, count(*) as n from (select unnest(string_split(text, '')) as c from documents) where c <> '' group by cp)
    select spec, lo, hi, coalesce(cast(sum(n) as bigint), 0) as n, count(cp) as distinct_points, coalesce(cast(sum(n) filter (cp between 65 and 90 or cp = 233) as bigint), 0) as allowed
    from specs left join counts on cp between lo and hi group by spec, lo, hi""")
def q62_codepoint_ranges(spark, sf_dir):
    """PRJ8, PRJ9: written ranges, the characters of all texts in them, and those that a list of ranges allows.

    The counts are broadcast: there are no more of them than Unicode has code points.
    """
    specs = parse_ranges(spark.createDataFrame([(s,) for s in _SPECS], "spec string"))
    counts = codepoint_counts(table(spark, sf_dir, "documents"))
    joined = specs.join(F.broadcast(counts), F.col("cp").between(F.col("lo"), F.col("hi")), "left")
    allowed = F.sum(F.when(in_ranges("cp", ((65, 90), (233, 233))), F.col("n")))
    return joined.groupBy("spec", "lo", "hi").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("cp").alias("distinct_points"), F.coalesce(allowed, F.lit(0)).alias("allowed"))


_PAGES = """
    select source as book_id, doc_id as page_number, 'data/' || source || '/' || doc_id || '.png' as image_path, case when n_chars % 5 = 0 then 0 when n_chars % 5 > 1 then n_chars / 1e6 end::double as ink_ratio,
           case when n_chars % 3 = 0 then 'rtl' end as direction from documents"""


def _pages(spark, sf_dir):
    n = F.col("n_chars")
    ink = F.when(n % 5 == 0, 0.0).when(n % 5 > 1, n / 1e6)
    path = F.concat(F.lit("data/"), "source", F.lit("/"), "doc_id", F.lit(".png"))
    return table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("page_number"), path.alias("image_path"), ink.alias("ink_ratio"), F.when(n % 3 == 0, "rtl").alias("direction"))


@query(f"select 'http://host/' || image_path as image, book_id, page_number, coalesce(direction, 'ltr') as direction from ({_PAGES}) where coalesce(ink_ratio, 1) <> 0")
def q63_task_rows(spark, sf_dir):
    """PRJ21, FLT1: the annotation tasks of all pages with ink."""
    return manifest.task_rows(_pages(spark, sf_dir), F.concat(F.lit("http://host/"), "image_path"))


@query(f"select book_id, page_number, ink_ratio = 0 as blank from ({_PAGES}) where coalesce(ink_ratio, 1) > 0 order by md5('42' || image_path), image_path limit 200")
def q64_page_sample(spark, sf_dir):
    """SRC7, FLT1, WIN13: a seeded sample of the pages with ink."""
    rows = files.frequency_pages(_pages(spark, sf_dir), 200, "42")
    return rows.select("book_id", "page_number", F.when(F.col("ink_ratio").isNotNull(), is_blank_page("ink_ratio")).alias("blank"))


@query(f"""
    with boxes as ({_BOXES})
    select page, ord, greatest(0, x - 8) as x1, greatest(0, y - 3) as y1, least(240, x + w + 8) as x2, least(130, y + h + 3) as y2, (x + (x + w)) / 2 as x_center, (y + (y + h)) / 2 as y_center from boxes""")
def q65_padded_boxes(spark, sf_dir):
    """PRJ23: boxes grown within their page, and their centres."""
    boxes = _boxes(spark, sf_dir).select("page", "ord", F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))
    return boxes.select("page", "ord", *padded(8, 3, F.lit(240.0), F.lit(130.0)), centre("x1", "x2").alias("x_center"), centre("y1", "y2").alias("y_center"))


@query(f"""
    with boxes as ({_BOXES}), bands as (select page, count(*) as n, count(*) filter (w >= 66) as long, sum(case when w >= 66 then w else 0 end) as long_width, max(y + h) - min(y) as height from boxes group by page)
    select page, (n <= 4 or (n <= 6 and long >= 1)) and height <= greatest(24, floor(4000 * 0.025)) as modifier,
           case when n > 85 then false when long >= 8 and long_width >= 300 then true else long >= 3 and long_width >= 150 and n <= 75 end as row_like from bands""")
def q66_band_roles(spark, sf_dir):
    """FLT10, FLT11: bands that are marks above a row, and bands that a text mask keeps."""
    long = F.col("w") >= 66
    bands = _boxes(spark, sf_dir).groupBy("page").agg(F.count("*").alias("n"), F.count_if(long).alias("long"), F.sum(F.when(long, F.col("w")).otherwise(0.0)).alias("long_width"), (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("height"))
    return bands.select("page", is_modifier("n", "long", "height", F.lit(4000)).alias("modifier"), is_probable_row("n", "long", "long_width").alias("row_like"))


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_quantity * 4 >= 80 and l_discount * 8 between 0.04 and 0.55 and l_tax * 2 >= 0.08 and l_linenumber >= 4 and l_quantity / (l_linenumber * 5.0::double) between 0.3 and 3.5 as fits
    from lineitem""")
def q67_template_fits(spark, sf_dir):
    """FLT3: templates with enough shape, from their metrics."""
    fits = template_fits(F.col("l_quantity") * 4, F.col("l_discount") * 8, F.col("l_tax") * 2, "l_linenumber", "l_quantity", F.col("l_linenumber") * F.lit(5.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fits.alias("fits"))


_TALL = "least(g.y2, r.y2) - greatest(g.y1, r.y1)"
_MEETS = f"""{_TALL} > 0 and ({_TALL}) / greatest(1, least(g.y2 - g.y1, r.y2 - r.y1)) >= 0.15
    and greatest(0, least(g.x2, r.x2) - greatest(g.x1, r.x1)) / greatest(1, least(g.x2 - g.x1, r.x2 - r.x1)) >= 0.05"""


@query(f"""
    with recursive boxes as ({_BOXES}), rows as (select page, ord, x as x1, y as y1, x + w as x2, y + h as y2, row_number() over (partition by page order by y, ord) as k from boxes),
    fold as (
        select page, ord, k, 0::bigint as band, [{{'g': 0::bigint, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}] as live from rows where k = 1
        union all
        select page, ord, k, coalesce(hit, len(live)),
               case when hit is null then list_append(live, {{'g': len(live), 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}})
                    else list_transform(live, lambda g: case when g.g = hit then {{'g': g.g, 'x1': least(g.x1, x1), 'y1': least(g.y1, y1), 'x2': greatest(g.x2, x2), 'y2': greatest(g.y2, y2)}} else g end) end
        from (select r.*, f.live, list_filter(f.live, lambda g: {_MEETS})[1].g as hit from fold f join rows r on r.page = f.page and r.k = f.k + 1))
    select page, ord, cast(band as int) as band_index from fold""")
def q68_overlap_groups(spark, sf_dir):
    """GRD4: boxes that join the first earlier group whose outer box they overlap."""
    boxes = _boxes(spark, sf_dir).select("page", "ord", F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))
    return folds.merge_overlapping(boxes, ["page"], ["ord"]).select("page", "ord", "band_index")


@query("select p_partkey, p_brand, cast(p_size as double) as pt from part qualify p_brand not in ('Brand#1', 'Brand#3') or p_size = max(p_size) over (partition by p_brand)")
def q69_largest_sizes(spark, sf_dir):
    """FLT15: groups of two names keep their largest size only."""
    variants = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.col("p_brand").alias("group_id"), F.array("p_brand").alias("icons"), F.col("p_size").cast("double").alias("pt"))
    return stats.largest_sizes(variants, ["Brand#1", "Brand#3"]).select("p_partkey", "p_brand", "pt")


_MEMBERS = "select id, key, row_number() over (partition by id order by key) as m from (select distinct l_orderkey as id, l_partkey as key from lineitem)"


def _groups(spark, sf_dir):
    """Orders as groups of parts: id, representative (the least part), members, icons (flags of the order's lines)."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_partkey").alias("representative"), F.array_sort(F.collect_set("l_partkey")).alias("members"), F.array_sort(F.collect_set("l_returnflag")).alias("icons"))


@query("""
    select l_orderkey as id, case when bool_or(l_returnflag = 'R') then cast(min(l_partkey) as varchar) else string_agg(distinct cast(l_partkey as varchar), ' ' order by cast(l_partkey as varchar)) end as members from lineitem group by l_orderkey""")
def q70_template_members(spark, sf_dir):
    """FLT16: groups that carry a name are matched by their representative alone."""
    members = F.array_sort(F.transform("members", lambda m: m.cast("string")))
    return stats.template_members(_groups(spark, sf_dir), "R").select("id", F.array_join(members, " ").alias("members"))


@query(f"""
    with members as ({_MEMBERS}), icons as (select p_partkey as key, 0 as pos, p_type as icon from part union all select p_partkey, 1, p_brand from part),
    first as (select id, icon, min(m * 10 + pos) as spot from members left join icons using (key) group by id, icon)
    select id, coalesce(string_agg(icon, ' ' order by spot), '') as icons from first group by id""")
def q71_group_icons(spark, sf_dir):
    """JN4, JN16, SET5: each group's icon names by its members' order, each once."""
    part = table(spark, sf_dir, "part")
    icons = part.select(F.col("p_partkey").alias("key"), F.posexplode(F.array("p_type", "p_brand")).alias("pos", "icon"))
    return shapes.icons_of_groups(_groups(spark, sf_dir).drop("icons"), icons).select("id", F.array_join("icons", " ").alias("icons"))


@query(f"""
    with members as ({_MEMBERS})
    select id, printf('U+%04X', min(key)) as representative, string_agg(printf('U+%04X', key) || '=' || coalesce(p_name, '') || '/' || coalesce(case when p_size > 25 then p_type || '+' || p_brand end, ''), ' ' order by m) as members
    from members left join part on key = p_partkey group by id""")
def q72_group_records(spark, sf_dir):
    """SNK5, PRJ31: groups with their members' code points, names and icons."""
    part = table(spark, sf_dir, "part")
    names = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("glyph_name"))
    icons = part.where("p_size > 25").select(F.col("p_partkey").alias("key"), F.array("p_type", "p_brand").alias("icons"))
    found = sinks.groups_json(_groups(spark, sf_dir).drop("icons"), names, icons)
    member = F.transform("members", lambda m: F.concat(m["codepoint"], F.lit("="), F.coalesce(m["glyphName"], F.lit("")), F.lit("/"), F.array_join(m["icons"], "+")))
    return found.select("id", "representative", F.array_join(member, " ").alias("members"))


@query("""
    with counts as (select event_type as label, count(*) as n from events group by all), known as (select label, unicode(label) as cp, n from counts union all select 'none', 0, 0)
    select label, n, round(n / 1000, 3) as per_page, round(100.0 * n / sum(n) over (), 3) as pct, cast(row_number() over (order by n desc, cp) as int) as rank from known""")
def q73_frequency_table(spark, sf_dir):
    """AGG6-AGG8, WIN5, WIN14: detections by page and label, added up and ranked; labels without any are listed too."""
    found = table(spark, sf_dir, "events").select(F.col("user_id").alias("page"), F.col("event_type").alias("label"))
    known = found.select("label").distinct().select("label", F.ascii("label").alias("cp")).unionByName(spark.createDataFrame([("none", 0)], "label string, cp int"))
    return matching.frequency_table(matching.page_counts(found), known, 1000).select("label", "n", "per_page", "pct", "rank")


@query("""
    with twice as (select l_partkey as icon, count(*) as n from lineitem group by all having count(*) <> 1)
    select 'misplaced' as fault, icon, n from twice where icon not in (select p_partkey from part where p_size <= 10)
    union all select 'orphan', c_custkey, 0 from customer where c_custkey not in (select o_custkey from orders)""")
def q74_orphans(spark, sf_dir):
    """FLT17, SET3, AGG17, PRJ15: entries in none or several lists, and entries that nothing represents."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    wrong = taxonomy.misplaced(line.select(F.col("l_partkey").alias("icon"), F.col("l_suppkey").alias("grp")), part.where("p_size <= 10").select(F.col("p_partkey").alias("icon")))
    lost = taxonomy.orphans(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("icon")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("icon")))
    return wrong.select(F.lit("misplaced").alias("fault"), "icon", "n").unionByName(lost.select(F.lit("orphan").alias("fault"), "icon", F.lit(0).cast("long").alias("n")))


@query("""
    select l_orderkey, l_linenumber, l_partkey, greatest(l_discount * 8, l_tax * 10) * case when l_linenumber > 1 and l_quantity / ((l_linenumber - 1) * 6.0::double) between 0.55 and 2.40 then 1 else 0.65::double end as score from lineitem""")
def q75_decorated_score(spark, sf_dir):
    """IMG16: the better of two similarities, lowered where the ink differs too much."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") * 8).alias("full"), (F.col("l_tax") * 10).alias("central"), F.col("l_quantity").alias("ink"), ((F.col("l_linenumber") - 1) * F.lit(6.0)).alias("base_ink"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", shapes.decorated_score("full", "central", "ink", "base_ink").alias("score"))
