"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.chat import format_chats
from inkmill.llm.kneser_ney import classify
from inkmill.llm.licences import find_licences
from inkmill.llm.minhash import OnePermutation, compare_with_next
from inkmill.llm.mixing import mix_words
from inkmill.llm.nndescent import near_embeddings
from inkmill.llm.packing import pack
from inkmill.llm.simhash import simhash_groups
from inkmill.llm.toxicity import fit, score
from inkmill.llm.urlfilter import SOFT_TERMS, STRICT_TERMS, judge_urls

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
TOKENIZER = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document at two bits."""
    groups = simhash_groups(_table(spark, sf_dir, "documents"), "doc_id", "text", width=3, max_distance=2)
    return groups.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in windows of 1024 ids."""
    return pack(_table(spark, sf_dir, "documents"), "doc_id", "text", *TOKENIZER, window=1024, end_id=0).withColumnRenamed("id", "doc_id")


@_query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of weights 5, 2, 1 takes of every document."""
    mixed = mix_words(_table(spark, sf_dir, "documents"), "doc_id", "text", "source", weights=(5, 2, 1), limit=3)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def held_out(doc_id) -> Column:
    """The fifth of the ids that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from four fifths of the labels."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels.where(~held_out("doc_id"))))
    return scored.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids that are labelled as good text."""
    return labels.where("quality = 1").select(F.col("doc_id").alias("id"))


@_query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document under a model of the text that is labelled good."""
    judged = classify(_table(spark, sf_dir, "documents"), trusted_ids(_table(spark, sf_dir, "labels")))
    return judged.withColumnRenamed("id", "doc_id")


@_query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, 512 bins of four bits over five-word shingles."""
    return compare_with_next(_table(spark, sf_dir, "documents"), "doc_id", "text", OnePermutation(bin_bits=9, low_bits=4, width=5)).withColumnRenamed("id", "doc_id")


#: The rules of the registered query.
URL_RULES = [("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "block"), ("example.net/de/8", "block"), ("org/es/", "block")]


@_query
def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL."""
    return judge_urls(_table(spark, sf_dir, "pages"), "page_id", "url", URL_RULES).withColumnRenamed("id", "page_id")


def _url_sql() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def hits(terms) -> str:
        return " + ".join(f"cast(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') as int)" for t in terms)

    def fits(rule: str) -> str:
        host, _, path = rule.partition("/")
        return f"((host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '/{path}'))"

    rules = sorted(URL_RULES, key=lambda r: -len(r[0]))
    rule = " ".join(f"when {fits(r)} then '{r}'" for r, _ in rules)
    action = " ".join(f"when '{r}' then '{a}'" for r, a in rules)
    return f"""
        with parts as (
            select page_id, {lower.format("coalesce(url, '')")} as u,
                   coalesce(nullif(strpos(url, '://'), 0) + 3, 0) as pos, coalesce(url, '') as url from pages),
        split as (
            select page_id, u, case when pos > 0 then {lower.format("regexp_extract(substr(url, pos), '^[^/?#]*')")} else '' end as host,
                   case when pos > 0 then regexp_extract(substr(url, pos), '^[^/?#]*([^?#]*)', 1) else '' end as path from parts),
        found as (
            select page_id, host, path, case {rule} end as rule, cast({hits(STRICT_TERMS)} as int) as strict_hits, cast({hits(SOFT_TERMS)} as int) as soft_hits from split)
        select page_id, host, path, rule,
               coalesce(case rule {action} end, case when strict_hits > 0 or soft_hits >= 2 then 'block' else 'allow' end) as verdict,
               strict_hits, soft_hits from found"""


ORACLE_SQL["op7_urls"] = _url_sql()


@_query
def op9_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered conversations that no longer conversation contains as its start."""
    return format_chats(_table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id").select("conv_id", "segment", F.col("turns").cast("long").alias("turns"), "rendered")


ORACLE_SQL["op9_chats"] = """
    with pieces as (
        select distinct conv_id, turn, '<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10) as piece from conversations),
    prefixes as (
        select conv_id, row_number() over w as k, count(*) over (partition by conv_id) as n,
               string_agg(piece, '') over (partition by conv_id order by turn rows unbounded preceding) as rendered
        from pieces window w as (partition by conv_id order by turn)),
    ends as (select conv_id, n, rendered from prefixes where k = n)
    select min(conv_id) as conv_id, cast(0 as int) as segment, n as turns, rendered from ends
    where not exists (select 1 from prefixes p where p.k < p.n and p.k = ends.n and p.rendered = ends.rendered)
    group by n, rendered"""


@_query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector at cosine 0.9."""
    return near_embeddings(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", threshold=0.9).withColumnRenamed("id", "vec_id")


@_query
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families that every document states."""
    found = find_licences(_table(spark, sf_dir, "documents"))
    families = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["family"])))
    return found.select(F.col("id").alias("doc_id"), F.array_join(families, ",").alias("families"), F.size("found").alias("statements"))
