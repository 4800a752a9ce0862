"""Corpus pipeline: documents -> quality -> toxicity -> near-duplicates -> mix -> packed windows.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before
kept, and returns a DataFrame; all but the last return the columns of
documents. Labels are read from the tables in sf_dir. Nulls, empty texts,
repeats, empty tables and extra columns are handled as each stage states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.llm.kneser_ney import without_rejected
from inkmill.llm.mixing import mix_documents
from inkmill.llm.packing import pack_sequences
from inkmill.llm.queries import TOKENIZER, held_out, trusted_ids
from inkmill.llm.simhash import one_of_each_group
from inkmill.llm.toxicity import fit, score_column
from inkmill.llm.work import discard, materialise, scoped


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose perplexity is over their language's threshold.

    An id under which any text is rejected goes with all its rows; rows with a
    null id, and texts without characters, stay.
    """
    trusted = trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return without_rejected(docs, trusted)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that score 0.5 or more; learnt from the labels of the documents that are left, but a held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = score_column(fit(docs, labels.where(~held_out("doc_id"))))
    return docs.where(toxic(F.col("text")) < 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of similarity 0.8 over five-word shingles: the one with the smallest id.

    Null ids come after all others; of rows with one id the first by a hash of
    the whole row stays, and of rows that are equal throughout, one.
    """
    return one_of_each_group(docs, "doc_id", "text", similarity=0.8, width=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of source weights 5, 2, 1 takes it, up to three times."""
    return mix_documents(docs, "doc_id", "text", "source", weights=(5, 2, 1), limit=3)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents in windows of 1024 ids: sequence_id, n_tokens, ids, and the pieces of documents that a window holds."""
    packed = pack_sequences(docs, "doc_id", "text", *TOKENIZER, window=1024, end_id=0)
    named = F.transform("pieces", lambda x: F.struct(x["id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length"), x["offset"].alias("offset")))
    return packed.withColumn("pieces", named)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: Trained models and seeded hashes decide what stays, which SQL cannot express; tests hold each stage against a plain version.
ORACLE_SQL = None


@scoped
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written and read again as the next one's input; what a stage wrote goes once the next is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        if before:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
