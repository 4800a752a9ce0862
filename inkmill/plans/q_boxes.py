"""Boxes, rows, bands, pairing and suppression; lineitem rows are read as boxes, users and orders as pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.functions.boxes import iou, overlap, percent_to_centre, pixels_to_percent, width_share, yolo_line
from inkmill.operators import folds, reading, suppress
from inkmill.operators.layout import pair_texts
from inkmill.plans.registry import query, table


def _boxes(spark, sf_dir) -> DataFrame:
    """page, ord, x, y, w, h, score, priority; ord is unique within a page."""
    line = table(spark, sf_dir, "lineitem")
    ord_ = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return line.select(
        F.col("l_orderkey").alias("page"),
        ord_.alias("ord"),
        (F.col("l_quantity") * 4).alias("x"),
        F.floor(F.col("l_discount") * 1000 + 0.5).cast("double").alias("y"),
        (F.lit(60.0) + F.col("l_linenumber") * 3).alias("w"),
        F.lit(40.0).alias("h"),
        F.col("l_tax").alias("score"),
        F.when(F.col("l_returnflag") == "R", 50).when(F.col("l_returnflag") == "A", 20).otherwise(10).alias("priority"),
    )


_BOXES = """
    select l_orderkey as page, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as int) as ord,
           l_quantity * 4 as x, floor(l_discount * 1000 + 0.5) as y, 60.0::double + l_linenumber * 3 as w, 40.0::double as h, l_tax as score,
           case when l_returnflag = 'R' then 50 when l_returnflag = 'A' then 20 else 10 end as priority from lineitem"""


def _iou(a: str, b: str) -> str:
    inter = f"greatest(0, least({a}.x + {a}.w, {b}.x + {b}.w) - greatest({a}.x, {b}.x)) * greatest(0, least({a}.y + {a}.h, {b}.y + {b}.h) - greatest({a}.y, {b}.y))"
    return f"(({inter}) / ({a}.w * {a}.h + {b}.w * {b}.h - ({inter})))"


@query("""
    with recursive rows as (select user_id, event_id, value, row_number() over (partition by user_id order by value, event_id) as k from events),
    fold as (
        select user_id, k, event_id, value, 0 as row_index, 1 as n, value as total from rows where k = 1
        union all
        select r.user_id, r.k, r.event_id, r.value, case when abs(r.value - total / n) <= 3 then row_index else row_index + 1 end,
               case when abs(r.value - total / n) <= 3 then n + 1 else 1 end, case when abs(r.value - total / n) <= 3 then total + r.value else r.value end
        from fold f join rows r on r.user_id = f.user_id and r.k = f.k + 1)
    select user_id, event_id, row_index, cast(row_number() over (partition by user_id, row_index order by event_id) as int) as place from fold""")
def q13_reading_rows(spark, sf_dir):
    """GRD1, GRD2, WIN11: rows of near positions, and the reading order within them."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    rows = folds.row_groups(events, ["user_id"], "value", ["event_id"], 3.0)
    place = F.row_number().over(Window.partitionBy("user_id", "row_index").orderBy("event_id"))
    return rows.select("user_id", "event_id", "row_index", place.alias("place"))


@query(f"""
    with recursive boxes as ({_BOXES}), rows as (select page, x as x1, y as y1, x + w as x2, y + h as y2, row_number() over (partition by page order by y, ord) as k from boxes),
    fold as (
        select page, k, 0 as band_index, x1, y1, x2, y2, x1 as a1, y1 as b1, x2 as a2, y2 as b2 from rows where k = 1
        union all
        select r.page, r.k, case when ok then band_index else band_index + 1 end, r.x1, r.y1, r.x2, r.y2,
               case when ok then least(a1, r.x1) else r.x1 end, case when ok then least(b1, r.y1) else r.y1 end, case when ok then greatest(a2, r.x2) else r.x2 end, case when ok then greatest(b2, r.y2) else r.y2 end
        from (select r.*, f.band_index, a1, b1, a2, b2, r.y1 - b2 <= 10 and greatest(0, least(a2, r.x2) - greatest(a1, r.x1)) / greatest(1, least(a2 - a1, r.x2 - r.x1)) >= 0.15 as ok
              from fold f join rows r on r.page = f.page and r.k = f.k + 1) r)
    select page, band_index, min(x1) as x1, min(y1) as y1, max(x2) as x2, max(y2) as y2, count(*) as n from fold group by page, band_index""")
def q14_band_merge(spark, sf_dir):
    """GRD3, AGG10: text bands merged by gap and shared width."""
    bands = _boxes(spark, sf_dir).select("page", "ord", F.col("x").alias("x1"), F.col("y").alias("y1"), (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"), F.lit(10).alias("gap"))
    merged = folds.merge_bands(bands, ["page"], ["ord"], "gap")
    return merged.groupBy("page", "band_index").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"), F.count("*").alias("n"))


@query("""
    with chants as (select user_id, event_id as chant_id, epoch_us(ts) as y, lead(epoch_us(ts), 1, 9223372036854775807) over (partition by user_id order by ts, event_id) as next from events where event_type = 'click'),
    texts as (select user_id, event_id as text_id, epoch_us(ts) as y from events where event_type = 'view'),
    pairs as (select t.text_id, c.chant_id from texts t join chants c on c.user_id = t.user_id and t.y > c.y and t.y - c.y <= 21600000000 and t.y < c.next),
    firsts as (select user_id, min(y) as first from chants group by user_id)
    select t.user_id, t.text_id, p.chant_id,
           case when p.chant_id is not null then 'lyrics' when t.y < coalesce(first, 9223372036854775807) then 'non_score'
                when exists (select 1 from chants c where c.user_id = t.user_id and t.y > c.y and t.y - c.y <= 21600000000) then 'unpaired' else 'non_score' end as route
    from texts t left join pairs p on p.text_id = t.text_id left join firsts f on f.user_id = t.user_id""")
def q15_lyric_pairing(spark, sf_dir):
    """WIN4, JN10, JN11, JN17, JN18: texts to the row above them within reach and before the next row."""
    events = table(spark, sf_dir, "events").withColumn("y", F.unix_micros(F.col("ts").cast("timestamp")))
    rows = events.where("event_type = 'click'").select("user_id", F.col("event_id").alias("chant_id"), F.col("y").alias("y1"), F.col("y").alias("y2"))
    texts = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("text_id"), F.col("y").alias("y1"), F.col("y").alias("y2"))
    return pair_texts(rows, texts, ["user_id"], "chant_id", "text_id", F.lit(6 * 3_600_000_000), F.lit((1 << 63) - 1)).select("user_id", "text_id", "chant_id", "route")


@query(f"""
    with boxes as ({_BOXES})
    select page, ord from boxes t where exists (select 1 from boxes c where c.page = t.page and c.ord <> t.ord and t.y + t.h / 2 > c.y + c.h / 2 and greatest(0, t.y - (c.y + c.h)) <= 10)""")
def q16_exists_near(spark, sf_dir):
    """JN11, JN13: boxes with another close above them."""
    boxes = _boxes(spark, sf_dir)
    t, c = (boxes.select("page", *[F.col(k).alias(f"{p}{k}") for k in ("ord", "y", "h")]) for p in ("t", "c"))
    above = (F.col("cord") != F.col("tord")) & (F.col("ty") + F.col("th") / 2 > F.col("cy") + F.col("ch") / 2) & (F.greatest(F.lit(0), F.col("ty") - (F.col("cy") + F.col("ch"))) <= 10)
    return t.join(c.withColumnRenamed("page", "cpage"), (F.col("page") == F.col("cpage")) & above, "left_semi").select("page", F.col("tord").alias("ord"))


@query(f"""
    with boxes as ({_BOXES})
    select page, ord from boxes t where priority < 50 and not exists (
        select 1 from boxes c where c.page = t.page and c.priority = 50 and greatest(0, least(t.y + t.h, c.y + c.h) - greatest(t.y, c.y)) / greatest(1, t.h) >= 0.35 and t.y + t.h / 2 <= c.y + c.h / 2)""")
def q17_inside_filter(spark, sf_dir):
    """JN12, JN17: text boxes that do not lie within a row's box."""
    boxes = _boxes(spark, sf_dir)
    t = boxes.where("priority < 50").select("page", *[F.col(k).alias(f"t{k}") for k in ("ord", "y", "h")])
    c = boxes.where("priority = 50").select(F.col("page").alias("cpage"), *[F.col(k).alias(f"c{k}") for k in ("y", "h")])
    share = overlap("ty", F.col("ty") + F.col("th"), "cy", F.col("cy") + F.col("ch")) / F.greatest(F.lit(1), F.col("th"))
    inside = (share >= 0.35) & (F.col("ty") + F.col("th") / 2 <= F.col("cy") + F.col("ch") / 2)
    return t.join(c, (F.col("page") == F.col("cpage")) & inside, "left_anti").select("page", F.col("tord").alias("ord"))


@query(f"""
    with boxes as ({_BOXES})
    select a.page, a.ord as i, b.ord as j, round({_iou("a", "b")}, 6) as iou from boxes a join boxes b on a.page = b.page and a.ord < b.ord where {_iou("a", "b")} >= 0.1""")
def q18_iou_pairs(spark, sf_dir):
    """PRJ24, PRJ25: overlapping pairs of boxes of a page."""
    boxes = _boxes(spark, sf_dir)
    a, b = (boxes.select("page", *[F.col(k).alias(f"{p}{k}") for k in ("ord", "x", "y", "w", "h")]) for p in ("a", "b"))
    pairs = a.join(b, "page").where(F.col("aord") < F.col("bord")).withColumn("iou", iou("a", "b"))
    return pairs.where("iou >= 0.1").select("page", F.col("aord").alias("i"), F.col("bord").alias("j"), F.round("iou", 6).alias("iou"))


def _nms(order: str, threshold: float) -> str:
    box = "{'x': r.x, 'y': r.y, 'w': r.w, 'h': r.h}"
    return f"""
    with recursive boxes as ({_BOXES}), ranked as (select *, row_number() over (partition by page order by {order}, ord) as k from boxes),
    walk as (
        select page, k, ord, true as kept, [{box}] as held from ranked r where k = 1
        union all
        select page, k, ord, ok, case when ok then list_append(held, {box}) else held end
        from (select r.*, w.held, len(list_filter(w.held, lambda b: {_iou("b", "r")} >= {threshold})) = 0 as ok from walk w join ranked r on r.page = w.page and r.k = w.k + 1) r)
    select page, ord from walk where kept"""


@query(_nms("(priority >= 50) desc, w * h desc, priority desc, score desc", 0.3))
def q19_nms_complex(spark, sf_dir):
    """GRD5: suppression that protects high priorities and prefers large boxes."""
    return suppress.suppress(_boxes(spark, sf_dir), ["page"], suppress.complex_order(), ["ord"], 0.3).select("page", "ord")


@query(_nms("score desc", 0.2))
def q20_nms_score(spark, sf_dir):
    """GRD6, GRD7: suppression by score alone."""
    return suppress.suppress(_boxes(spark, sf_dir), ["page"], suppress.cascade_order(score_only=True), ["ord"], 0.2).select("page", "ord")


@query("""
    select l_orderkey, l_linenumber, l_partkey, printf('%d %.6f %.6f %.6f %.6f', l_linenumber, least(1.0, (l_quantity + (20 + l_linenumber) / 2) / 100), least(1.0, (l_tax * 1000 + 12) / 100), (20 + l_linenumber) / 100, 0.24) as line,
           cast(round(l_quantity * 4 / 400 * 100, 4) as double) as x, cast(round(l_linenumber * 7 / 200 * 100, 4) as double) as y from lineitem""")
def q34_boxes_norm(spark, sf_dir):
    """PRJ18-PRJ20: label lines from percent boxes, and percent boxes from pixels."""
    line = table(spark, sf_dir, "lineitem").select("*", F.col("l_quantity").alias("bx"), (F.col("l_tax") * 1000).alias("by"), (F.lit(20.0) + F.col("l_linenumber")).alias("bw"), F.lit(24.0).alias("bh"))
    box = percent_to_centre("bx", "by", "bw", "bh")
    back = pixels_to_percent(F.col("l_quantity") * 4, F.col("l_linenumber") * 7, "bw", "bh", F.lit(400.0), F.lit(200.0))
    return line.select("l_orderkey", "l_linenumber", "l_partkey", yolo_line("l_linenumber", *box).alias("line"), back[0], back[1])


@query("select user_id as page, event_id, event_type as group_id, value as score from events")
def q46_detections_flat(spark, sf_dir):
    """SNK6, SNK7: detections nested by page, and flat again."""
    events = table(spark, sf_dir, "events")
    nested = events.groupBy(F.col("user_id").alias("page")).agg(F.collect_list(F.struct("event_id", F.col("event_type").alias("group_id"), F.col("value").alias("score"))).alias("detections"))
    return nested.select("page", F.explode("detections").alias("d")).select("page", "d.event_id", "d.group_id", "d.score")


@query("""
    with hist as (select cast(floor(l_extendedprice / 500) % 256 as int) as v, count(*) as c from lineitem group by 1),
    run as (select v, c, sum(c) over (order by v) as w0, sum(v * c) over (order by v) as s0, sum(c) over () as w, sum(v * c) over () as s from hist),
    var as (select v, case when w0 < w then w0::double * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) ** 2 else 0 end as b from run)
    select arg_max(v, b) as threshold from var""")
def q48_otsu(spark, sf_dir):
    """IMG2: the threshold that best separates a histogram in two."""
    from inkmill.operators.matching import otsu_of_histogram

    value = F.pmod(F.floor(F.col("l_extendedprice") / 500), F.lit(256)).cast("int")
    return otsu_of_histogram(table(spark, sf_dir, "lineitem").groupBy(value.alias("v")).agg(F.count("*").alias("c")))


@query(f"""
    with boxes as ({_BOXES}), stats as (select page, count(*) as n, count(*) filter (w >= 66) as long, cast(sum(case when w >= 66 then w else 0 end) as double) as long_width, max(x + w) - min(x) as width, max(y + h) - min(y) as height from boxes group by page),
    flags as (select *, case when n > 75 then false when long >= 3 and long_width >= 300 then n <= 18 or long / n >= 0.32 when width < 300 and long >= 3 and long_width >= 90 then true else n <= 18 and long >= 5 and long_width >= 220 end as notation from stats)
    select page, n, long, notation, not notation and (n >= 2 or width >= 40) and height >= 4 as text from flags""")
def q55_band_kinds(spark, sf_dir):
    """FLT7-FLT9, AGG11: kinds of bands by their counts of boxes and long boxes."""
    from inkmill.functions.boxes import is_notation, is_text

    long = F.col("w") >= 66
    bands = _boxes(spark, sf_dir).groupBy("page").agg(F.count("*").alias("n"), F.count_if(long).alias("long"), F.sum(F.when(long, F.col("w")).otherwise(0.0)).alias("long_width"), (F.max(F.col("x") + F.col("w")) - F.min("x")).alias("width"), (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("height"))
    notation = is_notation("n", "long", "long_width", "width")
    return bands.select("page", "n", "long", notation.alias("notation"), is_text("n", "width", "height", notation).alias("text"))


@query(f"""
    with boxes as ({_BOXES})
    select a.page, a.ord, b.ord as other, greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) / greatest(1, least(a.w, b.w)) as share
    from boxes a join boxes b on a.page = b.page and a.ord < b.ord where a.priority = 50 and b.priority <> 50""")
def q56_width_share(spark, sf_dir):
    """PRJ24, JN14: shared width of rows and the marks of their page."""
    boxes = _boxes(spark, sf_dir).withColumns({"x1": F.col("x"), "x2": F.col("x") + F.col("w")})
    a, b = (boxes.where(f"priority {op} 50").select("page", *[F.col(k).alias(f"{p}{k}") for k in ("ord", "x1", "x2")]) for p, op in (("a", "="), ("b", "<>")))
    return a.join(b, "page").where(F.col("aord") < F.col("bord")).select("page", F.col("aord").alias("ord"), F.col("bord").alias("other"), width_share("a", "b").alias("share"))


@query("""
    with recursive rows as (select user_id, event_id, value, row_number() over (partition by user_id order by value, event_id) as k from events),
    fold as (
        select user_id, k, event_id, value, 0 as row_index, 1 as n, value as total from rows where k = 1
        union all
        select r.user_id, r.k, r.event_id, r.value, case when abs(r.value - total / n) <= 3 then row_index else row_index + 1 end,
               case when abs(r.value - total / n) <= 3 then n + 1 else 1 end, case when abs(r.value - total / n) <= 3 then total + r.value else r.value end
        from fold f join rows r on r.user_id = f.user_id and r.k = f.k + 1),
    sides as (select user_id, row_index, case when avg(event_id) > 1000 / 2 then 'rtl' else 'ltr' end as direction from fold group by all)
    select user_id, event_id, row_index, direction, cast(row_number() over (partition by user_id order by row_index, case when direction = 'rtl' then -event_id else event_id end) - 1 as int) as place
    from fold join sides using (user_id, row_index)""")
def q58_reading_order(spark, sf_dir):
    """GRD2, AGG13, WIN11: rows, each row's direction, and the order of reading."""
    events = table(spark, sf_dir, "events")
    x, y = F.col("event_id").cast("double"), F.col("value")
    boxes = events.select("user_id", F.col("event_id").alias("ord"), x.alias("x1"), x.alias("x2"), y.alias("y1"), y.alias("y2"), F.lit(1000.0).alias("width"))
    return reading.reading_order(boxes, ["user_id"], width="width", tolerance=3.0).select("user_id", F.col("ord").alias("event_id"), "row_index", "direction", "place")
