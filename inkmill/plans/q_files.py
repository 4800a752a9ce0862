"""Readers and writers: tables go through files and come back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from inkmill import schemas
from inkmill.functions.boxes import audit_passed
from inkmill.functions.text import codepoint_key
from inkmill.operators import annotate, matching
from inkmill.operators.work import scoped, scratch_folder
from inkmill.plans.registry import query, table
from inkmill.sources import files, sinks


@query("""
    select source as book_id, cast(doc_id as int) as page_number, format('data/pages/{}/page_{:04d}.png', source, doc_id) as image_path, sha256(text) as sha256, 400 as dpi,
           cast(n_chars as int) as width, cast(doc_id % 7 as int) as height, lang = 'en' as masked, case when lang = 'en' then 'rtl' else 'ltr' end as direction, case when lang = 'en' then 0.25 else 1.0 end::double as ink_ratio
    from documents""")
@scoped
def q59_manifest_files(spark, sf_dir):
    """SRC8, SNK1, JN2: a manifest is written, pages of one language are upserted, and it is read again with its defaults."""
    docs = table(spark, sf_dir, "documents")
    page = F.format_string("data/pages/%s/page_%04d.png", "source", "doc_id")
    columns = {"book_id": F.col("source"), "page_number": F.col("doc_id"), "image_path": page, "sha256": F.sha2("text", 256), "dpi": F.lit(400), "width": F.col("n_chars"), "height": F.col("doc_id") % 7}
    kinds = dict(c.split() for c in schemas.MANIFEST.split(", "))

    def rows(masked: bool, direction: str | None, ink: float | None):
        extra = {"masked": F.lit(masked), "direction": F.lit(direction), "ink_ratio": F.lit(ink)}
        return docs.select("lang", *[c.cast(kinds[k]).alias(k) for k, c in (columns | extra).items()])

    path = scratch_folder(spark, "manifest")
    sinks.write_manifest(spark, path, rows(False, None, None).drop("lang"))
    sinks.write_manifest(spark, path, rows(True, "rtl", 0.25).where("lang = 'en'").drop("lang"))
    return files.read_manifest(spark, path)


_STEM = "'r' || l_returnflag || l_linestatus || '-' || l_linenumber"


@query(f"""
    select {_STEM} as page_id, row_number() over (partition by {_STEM} order by l_orderkey, l_partkey, l_quantity, l_tax) as number, cast(l_linenumber % 3 as int) as class_id, 'c' || (l_linenumber % 3) as class_name,
           round_even(l_quantity / 64, 6) as x_center, 0.5::double as y_center, round_even(l_tax / 4, 6) as width, 0.125::double as height from lineitem""")
@scoped
def q60_label_files(spark, sf_dir):
    """SRC17, SRC18, SNK12, PRJ19, JN3: boxes are written as label files, and read and parsed again."""
    line = table(spark, sf_dir, "lineitem")
    stem = F.concat(F.lit("r"), "l_returnflag", "l_linestatus", F.lit("-"), "l_linenumber")
    boxes = line.select(
        F.concat(F.lit("data/pages/"), stem, F.lit(".png")).alias("image"),
        F.struct("l_orderkey", "l_partkey", "l_quantity", "l_tax").alias("ord"),
        (F.col("l_linenumber") % 3).cast("int").alias("class_id"),
        (F.col("l_quantity") / 64).alias("x_center"),
        F.lit(0.5).alias("y_center"),
        (F.col("l_tax") / 4).alias("width"),
        F.lit(0.125).alias("height"),
    )
    path = scratch_folder(spark, "labels")
    sinks.write_label_files(annotate.label_lines(boxes), path)
    lines = files.label_lines(spark, path).withColumn("path", F.concat(F.regexp_extract("path", "stem=([^/]*)", 1), F.lit(".txt")))
    classes = spark.createDataFrame([(k, f"c{k}") for k in range(3)], "class_id int, name string")
    found = annotate.parse_label_lines(lines, classes)
    return found.select("page_id", F.col("number").cast("long").alias("number"), "class_id", "class_name", "x_center", "y_center", "width", "height")


@query("""
    select source || '/' || doc_id as image_path, case when lang = 'en' then 'blank' else 'content' end as expected, n_chars / 1e6 as ink_ratio,
           case when lang = 'en' then n_chars / 1e6 <= 0.0003 else n_chars / 1e6 >= 0.0008 end as passed from documents""")
@scoped
def q76_audit_files(spark, sf_dir):
    """SRC10, SNK18, FLT13: an audit is written; its expectations and its results are read again."""
    n = F.col("n_chars") / 1e6
    audited = table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "doc_id").alias("image_path"), F.when(F.col("lang") == "en", "blank").otherwise("content").alias("expected"), n.alias("ink_ratio"))
    path = scratch_folder(spark, "audit")
    sinks.write_audit(audited.withColumn("passed", audit_passed("expected", "ink_ratio")), path)
    results = spark.read.schema("image_path string, expected string, ink_ratio double, passed boolean").option("header", "true").csv(path)
    return files.read_audit(spark, path).join(results.drop("expected"), "image_path")


@query("select 'http://host/' || s_name as image, cast(s_nationkey as varchar) as book_id, cast(s_suppkey as int) as page_number, case when s_acctbal < 0 then 'rtl' else 'ltr' end as direction from supplier")
@scoped
def q77_task_files(spark, sf_dir):
    """SRC16, SNK14: annotation tasks are written as one JSON array and read again."""
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.lit("http://host/"), "s_name").alias("image"), F.col("s_nationkey").cast("string").alias("book_id"), F.col("s_suppkey").cast("int").alias("page_number"), F.when(F.col("s_acctbal") < 0, "rtl").otherwise("ltr").alias("direction"))
    path = scratch_folder(spark, "tasks")
    sinks.write_tasks(rows, path)
    return files.read_tasks(spark, path).select("data.*")


@query("""
    select 'class' as kind, n_nationkey as number, 'mode.' || n_name as value from nation
    union all select 'symbol', cast(row_number() over (order by n_nationkey) - 1 as int), 'mode:' || n_name || ':' || substr(n_name, 1, 3) from nation
    union all select 'family', n_regionkey, string_agg(printf('U+%04X', n_nationkey + 65), ' ' order by n_nationkey) from nation group by n_regionkey
    union all select 'alias', cast(row_number() over (order by min(n_nationkey)) - 1 as int), string_agg(cast(n_nationkey + 65 as varchar), ' ' order by n_nationkey) from nation group by n_regionkey having count(*) > 1
    union all select 'gold', n_regionkey, string_agg(n_name, '|' order by n_nationkey) from nation group by n_regionkey""")
@scoped
def q78_configuration_files(spark, sf_dir):
    """SRC11, SRC15, SRC19, SRC20, SRC22, SNK13, SNK19: class names, a symbol map, families, aliases and gold compositions are written and read again."""
    nation = table(spark, sf_dir, "nation")
    folder = scratch_folder(spark, "configuration")
    sinks.write_yaml(spark, f"{folder}/classes.yaml", sinks.dataset_yaml(nation.select(F.col("n_nationkey").alias("class_id"), F.concat(F.lit("mode."), "n_name").alias("name")), "data"))
    symbols = nation.orderBy("n_nationkey").select(F.col("n_name").alias("icon"), F.lit("mode").alias("group"), F.substring("n_name", 1, 3).alias("insert"))
    sinks.write_json(symbols, f"{folder}/symbols.json", "symbols")
    point = F.col("n_nationkey") + 65
    regions = nation.groupBy("n_regionkey").agg(F.min(point).alias("base"), F.array_sort(F.collect_list(point)).alias("members"))
    coded = F.transform("members", lambda m: codepoint_key(m))
    sinks.write_json(regions.select(F.col("n_regionkey").cast("string").alias("id"), codepoint_key("base").alias("representative"), coded.alias("codepoints")), f"{folder}/families.json")
    sinks.write_yaml(spark, f"{folder}/aliases.yaml", {"families": sinks.proposals_yaml(regions.orderBy("base"), {})["proposals"]})
    parts = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", F.col("n_name").alias("composition")))).alias("rows"))
    for r in sinks.rows_of(parts):
        sinks.write_json(spark.createDataFrame([(s.composition,) for s in r.rows], "composition string"), f"{folder}/gold/{r.n_regionkey}/expected_composition.json", "segments")

    found = [
        files.read_class_names(spark, f"{folder}/classes.yaml").select(F.lit("class").alias("kind"), F.col("class_id").alias("number"), F.col("name").alias("value")),
        files.read_symbol_map(spark, f"{folder}/symbols.json").select(F.lit("symbol"), F.col("pos"), F.concat_ws(":", "group", "icon", "insert")),
        files.read_families(spark, f"{folder}/families.json").select(F.lit("family"), F.col("id").cast("int"), F.array_join("codepoints", " ")),
        files.read_aliases(spark, f"{folder}/aliases.yaml").select(F.lit("alias"), F.col("ord"), F.array_join(F.transform("keys", lambda k: k.cast("string")), " ")),
        files.gold_compositions(spark, f"{folder}/gold").select(F.lit("gold"), F.regexp_extract("doc_id", "/([0-9]+)/[^/]*$", 1).cast("int"), F.array_join("segments.composition", "|")),
    ]
    return reduce(lambda a, b: a.union(b), found)


@query("""
    with groups(id, members) as (values ('A', [65, 97]), ('N', [78]), ('R', [82, 57552]))
    select cast(l_orderkey as varchar) as page, id as group_id, printf('U+%04X', members[1]) as representative, cast(l_quantity as int) as x, l_linenumber as y, l_tax as score,
           case id when 'A' then 'U+0041 U+0061' when 'N' then 'U+004E' else 'U+0052 U+E0D0' end as members
    from lineitem join groups on l_returnflag = id""")
@scoped
def q79_detection_files(spark, sf_dir):
    """SNK7, JN16: detections are written flat beside their group's members, and read again."""
    line = table(spark, sf_dir, "lineitem")
    found = line.select(F.col("l_orderkey").cast("string").alias("page"), F.col("l_returnflag").alias("label"), F.col("l_quantity").cast("int").alias("x"), F.col("l_linenumber").alias("y"), F.lit(8).alias("w"), F.lit(9).alias("h"), F.col("l_tax").alias("score"), F.lit(12.0).alias("pt"))
    groups = spark.createDataFrame([("A", 65, [65, 97]), ("N", 78, [78]), ("R", 82, [82, 0xE0D0])], schemas.GROUP)
    path = scratch_folder(spark, "detections")
    sinks.write_detections(found, groups, path)
    read = spark.read.schema("page string, group_id string, representative string, x int, y int, width int, height int, score double, size_pt double, members string").option("header", "true").csv(path)
    return read.drop("width", "height", "size_pt")


_LABELS = "select 'c' || l_linenumber || '.' || l_returnflag as class_name, 'c' || l_linenumber as grp, l_returnflag as icon, l_linestatus as book from lineitem"


@query(f"""
    with rows as ({_LABELS})
    select 'frequency' as report, '' as book, class_name, count(*) as n, count(*) / sum(count(*)) over () as share from rows group by class_name
    union all select 'groups', '', grp, count(*), count(*) / sum(count(*)) over () from rows group by grp
    union all select 'per_book', book, class_name, count(*), count(*) / sum(count(*)) over (partition by book) from rows group by book, class_name""")
@scoped
def q80_statistics_files(spark, sf_dir):
    """SNK17, AGG1-AGG3: the statistics of label boxes are written as tables and read again."""
    line = table(spark, sf_dir, "lineitem")
    group = F.concat(F.lit("c"), "l_linenumber")
    boxes = line.select(
        F.col("l_orderkey").cast("string").alias("page_id"),
        F.col("l_linenumber").alias("number"),
        group.alias("group"),
        F.col("l_returnflag").alias("icon"),
        F.concat_ws(".", group, "l_returnflag").alias("class_name"),
        F.col("l_linestatus").alias("book_id"),
        F.col("l_tax").alias("x_center"),
        F.col("l_discount").alias("y_center"),
    )
    path = scratch_folder(spark, "statistics")
    sinks.write_statistics(boxes, path)

    def report(name: str, book, key: str):
        read = spark.read.option("header", "true").csv(f"{path}/{name}")
        return read.select(F.lit(name).alias("report"), book.alias("book"), F.col(key).alias("class_name"), F.col("count").cast("long").alias("n"), F.col("percentage").cast("double").alias("share"))

    return report("frequency", F.lit(""), "class_name").union(report("groups", F.lit(""), "group")).union(report("per_book", F.col("book_id"), "class_name"))


@query("""
    select 'pdf' as kind, r_name as name, 'top' as folder, r_name as content from region
    union all select 'icon', r_name, case when r_regionkey % 2 = 0 then 'first' else 'second' end, '' from region""")
@scoped
def q81_found_files(spark, sf_dir):
    """SRC1, SRC24: files in a folder but not below it, and each name's file in the first folder that has it."""
    folder = scratch_folder(spark, "found")
    for r in sinks.rows_of(table(spark, sf_dir, "region")):
        sinks.write_text(spark, f"{folder}/top/{r.r_name}.pdf", r.r_name)
        sinks.write_text(spark, f"{folder}/top/below/{r.r_name}.pdf", "lower")
        for place in ("first", "second") if r.r_regionkey % 2 == 0 else ("second",):
            sinks.write_text(spark, f"{folder}/{place}/{r.r_name}.gif", "gif")
    pdfs = files.pdf_files(spark, [f"{folder}/top"]).select(F.lit("pdf").alias("kind"), F.url_decode("book_id").alias("name"), F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("folder"), F.col("content").cast("string").alias("content"))
    icons = files.icon_files(spark, [f"{folder}/first", f"{folder}/second"]).select(F.lit("icon"), "icon", F.regexp_extract("path", "([^/]*)/[^/]*$", 1), F.lit(""))
    return pdfs.union(icons)


@query("""
    with parts as (select n_regionkey as k, string_agg(printf('U+%04X', n_nationkey + 65), ' ' order by n_nationkey) as points, string_agg(n_name, ', ' order by n_nationkey) as names, count(*) as n from nation group by n_regionkey),
    events as (select event_type as label, count(*) as n, row_number() over (order by count(*) desc, unicode(event_type)) as rank from events group by event_type)
    select 'families' as report, '<!doctype html><meta charset=utf-8><ul>' || string_agg('<li>f' || k || ': ' || points || '</li>', '' order by k) || '</ul>' as text from parts
    union all select 'matches', '<!doctype html><meta charset=utf-8><table>' || string_agg('<tr><td>f' || k || '</td><td>' || names || '</td><td><span class="count">' || n || '</span></td><td><div class="bar" style="width:'
        || cast(round_even(180 * n / (select max(n) from parts), 0) as int) || 'px"></div></td><td>' || points || '</td></tr>', '' order by n desc, k) || '</table>' from parts
    union all select 'frequencies', string_agg(printf('%4d %-24s %8d ', rank, label, n) || repeat('#', greatest(1, least(20, cast(floor(20 * n / (select max(n) from events)) as int)))), chr(10) order by rank) from events
    union all select 'sheet', '<!doctype html><meta charset=utf-8><h2>rest</h2>' || string_agg(case when n_nationkey >= 0 and n_regionkey = 0 then '<figure>' || case when n_nationkey % 2 = 0 then '<img src="' || n_nationkey || '.png">' else '' end || '<figcaption>' || n_nationkey || ' ' || n_name || '</figcaption></figure>' end, '' order by n_nationkey)
        || '<h2>mode</h2>' || string_agg(case when n_regionkey = 1 then '<figure>' || case when n_nationkey % 2 = 0 then '<img src="' || n_nationkey || '.png">' else '' end || '<figcaption>' || n_nationkey || ' ' || n_name || '</figcaption></figure>' end, '' order by n_nationkey) from nation""")
def q88_reports(spark, sf_dir):
    """SNK8, SNK10, SNK11, SNK21: reports of result tables as text: families, matches, frequencies and the reference sheet, whose unlisted groups are left out."""
    nation = table(spark, sf_dir, "nation")
    group = F.concat(F.lit("f"), "n_regionkey")
    point = (F.col("n_nationkey") + 65).cast("long")
    groups = nation.groupBy(group.alias("id")).agg(F.min(point).alias("representative"), F.array_sort(F.collect_list(point)).alias("members"))
    names = nation.groupBy(group.alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("icons"))
    found = table(spark, sf_dir, "events").select(F.col("user_id").alias("page"), F.col("event_type").alias("label"))
    known = found.select("label").distinct().select("label", F.ascii("label").alias("cp"))
    kind = F.when(F.col("n_regionkey") == 0, "rest").when(F.col("n_regionkey") == 1, "mode").otherwise("other")
    classes = nation.select(F.col("n_nationkey").alias("class_id"), F.concat_ws(".", kind, "n_name").alias("name"))
    urls = nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("icon"), F.concat("n_nationkey", F.lit(".png")).alias("url"))
    texts = [
        ("families", sinks.family_report(groups)),
        ("matches", sinks.match_report(groups, nation.groupBy(group.alias("label")).agg(F.count("*").alias("n")), names)),
        ("frequencies", sinks.frequency_report(matching.frequency_table(matching.page_counts(found), known, 1000))[1]),
        ("sheet", sinks.reference_sheet(classes, urls)),
    ]
    return spark.createDataFrame(texts, "report string, text string")
