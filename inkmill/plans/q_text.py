"""Code points, URLs, validation, hashes and serialised rows over the driver's tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from inkmill.functions.boxes import pt_to_px
from inkmill.functions.text import GLYPH_RANGES, codepoint_key, in_ranges, normal_key
from inkmill.operators import annotate, taxonomy, validate
from inkmill.plans.registry import query, table


def codepoint_counts(docs, text="text"):
    """AGG5-AGG7: occurrences of every code point: cp, n. Counted a batch at a time, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                joined = "".join(t for t in batch.column(0).slice(at, 512).to_pylist() if t)
                cp, n = np.unique(np.frombuffer(joined.encode("utf-32-le"), "<u4"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cp.astype(np.int32)), pa.array(n.astype(np.int64))], ["cp", "n"])

    return docs.select(text).mapInArrow(run, "cp int, n long").groupBy("cp").agg(F.sum("n").alias("n"))


_RANGES = " or ".join(f"cp between {lo} and {hi}" for lo, hi in GLYPH_RANGES)


@query(f"""
    with chars as (select unicode(c) as cp from (select unnest(string_split(text, '')) as c from documents)),
    counts as (select cp, count(*) as n from chars where {_RANGES} group by cp)
    select cast(cp as int) as cp, printf('U+%04X', cp) as key, n, round(100.0 * n / sum(n) over (), 6) as pct from counts""")
def q29_codepoint_freq(spark, sf_dir):
    counts = codepoint_counts(table(spark, sf_dir, "documents")).where(in_ranges("cp"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("cp", codepoint_key("cp").alias("key"), "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 6).alias("pct"))


#: A synthetic symbol table (pos, icon, insert).
_ICONS = [(0, "Alpha", "ae"), (1, "Beta", "e"), (2, "Alpha", "t"), (3, "Gamma", ""), (4, "Gamma", "o"), (5, "Delta", None), (6, "Beta", "ta")]
_ICON_ROWS = ", ".join(f"({p}, '{i}', {'null' if s is None else repr(s)})" for p, i, s in _ICONS)


@query(f"""
    with symbols(pos, icon, insert) as (values {_ICON_ROWS}),
    chars as (select pos, icon, unnest(string_split(insert, '')) as c, unnest(generate_series(1, length(insert))) as k from symbols where insert <> ''),
    seen as (select unicode(c) as cp, icon, min(pos * 1000 + k) as spot from chars group by all)
    select cast(cp as int) as cp, string_agg(icon, ' ' order by spot) as icons, arg_min(icon, spot) as first_icon from seen group by cp""")
def q30_icon_map(spark, sf_dir):
    icons = taxonomy.icons_by_codepoint(spark.createDataFrame(_ICONS, "pos int, icon string, insert string"))
    return icons.select("cp", F.array_join("icons", " ").alias("icons"), "first_icon")


@query(f"""
    with symbols(pos, icon, insert) as (values {_ICON_ROWS})
    select icon, arg_min(insert, pos) as insert from symbols where insert <> '' group by icon""")
def q52_first_insert(spark, sf_dir):
    """SRC12: the first non-empty insert of every icon."""
    return taxonomy.insert_by_icon(spark.createDataFrame(_ICONS, "pos int, icon string, insert string"))


#: A synthetic grammar. Modifiers r and s are variants of one sign.
BASES, ATOMS = "abcdefghijklmnopqu", " .,\n"
MODIFIERS = {"r": ("gorgon", "Ro"), "s": ("gorgon", "Ro"), "t": ("isson", "Tau"), "y": ("isson", "Psi")}
KEYS = {"the": ("The", "segmentStart"), "of": ("Of", "midOnly"), "ofer": ("Ofer", None), "en": ("En", "segmentStart")}


def synthetic_symbols(spark):
    rows = [(i, c.upper(), "neume", "base", c, None, None) for i, c in enumerate(BASES)]
    rows += [(100 + i, c, "rest", "rest", c, None, None) for i, c in enumerate(ATOMS)]
    rows += [(200 + i, icon, group, "modifier", c, {"insert": c, "long": None}, None) for i, (c, (group, icon)) in enumerate(MODIFIERS.items())]
    rows += [(300 + i, icon, "key_signature", "key_signature", text, None, role) for i, (text, (icon, role)) in enumerate(KEYS.items())]
    return spark.createDataFrame(rows, "pos int, icon string, group string, role string, insert string, variants map<string,string>, key_role string")


def _errors(spark, sf_dir):
    rows = validate.segments(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return validate.validate(rows, validate.grammar(synthetic_symbols(spark)))


_TOKENS = r"ofer|the|en|of|[abcdefghijklmnopqu][rsty]*|[ .,\n]|[rsty]|(?s:.)"
_ERRORS = rf"""
    with tokens as (select doc_id, unnest(t) as token, unnest(generate_series(1, len(t))) as k from (select doc_id, regexp_extract_all(text, '{_TOKENS}') as t from documents)),
    placed as (select *, sum(length(token)) over (partition by doc_id order by k) - length(token) as spot from tokens),
    modifiers as (select doc_id, spot, unnest(generate_series(2, length(token))) as i, token from placed where token not in ('the', 'en', 'of', 'ofer') and length(token) > 2),
    repeats as (select doc_id, spot + i - 1 as position, row_number() over (partition by doc_id, spot, case when substr(token, i, 1) in ('r', 's') then 'Ro' else substr(token, i, 1) end order by i) as r from modifiers),
    errors as (
        select doc_id, position, 'duplicate_modifier' as code from repeats where r > 1
        union all select doc_id, spot, case when token in ('the', 'en', 'of') then 'key_signature_role' when token in ('r', 's', 't', 'y') then 'modifier_without_base' else 'unknown_char' end
        from placed where (token in ('the', 'en') and spot > 0) or (token = 'of' and spot = 0) or token in ('r', 's', 't', 'y') or (length(token) = 1 and not regexp_matches(token, '[abcdefghijklmnopqursty .,\n]')))
    select doc_id, cast(position as int) as position, code from errors"""


@query(f"select doc_id, code, count(*) as n, min(position) as first, cast(sum(position) as bigint) as places from ({_ERRORS}) group by doc_id, code")
def q31_validate(spark, sf_dir):
    """TOK1-3, JN15: errors of every text by kind, where the first is, and a sum over all places."""
    return _errors(spark, sf_dir).groupBy("doc_id", "code").agg(F.count("*").alias("n"), F.min("position").cast("long").alias("first"), F.sum("position").alias("places"))


@query(f"select code, count(*) as n, count(distinct doc_id) as docs from ({_ERRORS}) group by code")
def q32_validate_summary(spark, sf_dir):
    per_doc = _errors(spark, sf_dir).groupBy("code", "doc_id").agg(F.count("*").alias("k"))
    return per_doc.groupBy("code").agg(F.sum("k").alias("n"), F.count("*").alias("docs"))


@query("""
    select page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host, regexp_extract(regexp_extract(url, '^([^?#]*)', 1), '([^/]*)$', 1) as base,
           regexp_extract(url, '[?&]page=([^&#]*)', 1) as page, 'https://files/' || regexp_extract(url, '^[a-z]+://[^/]*/?([^?#]*)', 1) as local from pages""")
def q35_url_paths(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1).alias("host"),
        F.regexp_extract(F.regexp_extract(url, "^([^?#]*)", 1), "([^/]*)$", 1).alias("base"),
        F.regexp_extract(url, "[?&]page=([^&#]*)", 1).alias("page"),
        F.concat(F.lit("https://files/"), F.regexp_extract(url, "^[a-z]+://[^/]*/?([^?#]*)", 1)).alias("local"),
    )


@query("select doc_id, sha256(text) as sha256, format('data/pages/{}/page_{:04d}.png', source, doc_id) as path from documents")
def q47_sha256(spark, sf_dir):
    path = F.format_string("data/pages/%s/page_%04d.png", "source", "doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), path.alias("path"))


@query("""
    with types as (select p_type as name, row_number() over (order by p_type) - 1 as i from (select distinct p_type from part)),
    palette(colours) as (values (['#1f77b4', '#ff7f0e', '#2ca02c', '#d62728', '#9467bd', '#8c564b', '#e377c2', '#7f7f7f', '#bcbd22', '#17becf']))
    select string_agg('<Label value="' || replace(replace('<' || name || '>', '<', '&lt;'), '>', '&gt;') || '" background="' || colours[i % 10 + 1] || '"/>', chr(10) order by i) as xml from types, palette""")
def q49_label_xml(spark, sf_dir):
    from pyspark.sql import Window

    types = table(spark, sf_dir, "part").select("p_type").distinct()
    classes = types.select((F.row_number().over(Window.orderBy("p_type")) - 1).alias("class_id"), F.concat(F.lit("<"), "p_type", F.lit(">")).alias("name"))
    items = F.array_sort(F.collect_list(F.struct("class_id", "element")))
    return annotate.label_elements(classes).agg(F.array_join(F.transform(items, lambda x: x["element"]), "\n").alias("xml"))


@query("""
    with keys(k) as (values ('U+4f'), ('0x006C'), ('1d11e'), ('u+E0D0')), sizes(pt) as (values (6.5), (7.0), (8.25), (0.5), (13.0))
    select upper(case when length(h) < 4 then lpad(h, 4, '0') else h end) as key, cast(pt as double) as pt, cast(greatest(4, round_even(cast(pt as double) * 300 / 72, 0)) as int) as px
    from (select regexp_replace(upper(k), '^(U\\+|0X)', '') as h0, regexp_replace(regexp_replace(upper(k), '^(U\\+|0X)', ''), '^0+', '') as h from keys), sizes""".replace("upper(case when", "'U+' || upper(case when"))
def q53_codepoint_keys(spark, sf_dir):
    """PRJ7, PRJ26: normal code-point keys and template sizes in pixels."""
    keys = spark.createDataFrame([("U+4f",), ("0x006C",), ("1d11e",), ("u+E0D0",)], "k string")
    sizes = spark.createDataFrame([(6.5,), (7.0,), (8.25,), (0.5,), (13.0,)], "pt double")
    return keys.crossJoin(F.broadcast(sizes)).select(normal_key("k").alias("key"), "pt", pt_to_px("pt").alias("px"))


@query("""
    select conv_id, cast(floor(turn / 2) as int) as segment_index, string_agg(text, '|' order by turn) as segment from conversations group by all""")
def q54_segments(spark, sf_dir):
    """PRJ22: segments of compositions from nested rows."""
    turns = table(spark, sf_dir, "conversations").withColumn("s", F.floor(F.col("turn") / 2).cast("int"))
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "|")
    return turns.groupBy("conv_id", F.col("s").alias("segment_index")).agg(parts.alias("segment"))
