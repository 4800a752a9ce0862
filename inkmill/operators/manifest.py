"""Page manifests: resume, upsert, planning (JN1, JN2, SNK1, SRC8-9, WIN1-2, SET2-3, PRJ21, PRJ27-28)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators.islands import chunk_runs, contiguous_runs


def pending(planned: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """JN1: planned rows whose key the manifest lacks."""
    return planned.join(manifest_keys(manifest, keys), keys, "left_anti")


def manifest_keys(manifest: DataFrame, keys: list[str]) -> DataFrame:
    """SRC9: distinct keys; rows with a null or empty part are left out."""
    whole = [F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "") for k in keys]
    out = manifest.select(*keys)
    for w in whole:
        out = out.where(w)
    return out.distinct()


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """JN2, SNK1, SET2: old rows whose key is not new, and all new rows, repeats among them included.

    A plain union of an anti-join; sort when writing, not here.
    """
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def plan_chunks(planned: DataFrame, manifest: DataFrame, book: str, page: str, size: int = 25) -> DataFrame:
    """WIN1, WIN2: inclusive page chunks that are still to do, per book: book, chunk_first, chunk_last."""
    todo = pending(planned, manifest, [book, page])
    return chunk_runs(contiguous_runs(todo, page, [book]), size).select(book, "chunk_first", "chunk_last")


def task_rows(manifest: DataFrame, url, *, skip_blank: bool = True, limit: int = 0) -> DataFrame:
    """PRJ21: annotation task rows of manifest pages; a limit of 0 or less means all."""
    rows = manifest.where(F.coalesce("ink_ratio", F.lit(1.0)) != 0) if skip_blank else manifest
    rows = rows.select(url.alias("image"), "book_id", "page_number", F.coalesce("direction", F.lit("ltr")).alias("direction"))
    return rows.limit(limit) if limit > 0 else rows
