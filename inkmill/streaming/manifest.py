"""Streaming manifest upsert: an extra on Structured Streaming, not a feature of the batch tools.

Each micro-batch of rendered pages is upserted with the batch operator. A
batch that is repeated after a failure gives the same manifest, as its keys
replace themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkmill import schemas
from inkmill.sources.sinks import write_manifest


def page_stream(spark, folder: str) -> DataFrame:
    """Rendered pages as they arrive, as Parquet files with the manifest's columns."""
    return spark.readStream.schema(schemas.MANIFEST).parquet(folder)


def keep_manifest(pages: DataFrame, manifest: str, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch; of a key's rows within one batch the largest image hash stays."""

    def put(batch: DataFrame, _: int) -> None:
        columns = [c for c in batch.columns if c not in ("book_id", "page_number")]
        once = batch.groupBy("book_id", "page_number").agg(F.max_by(F.struct(*columns), "sha256").alias("r")).select("book_id", "page_number", "r.*")
        if once.limit(1).count():
            write_manifest(batch.sparkSession, manifest, once)

    return pages.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Rows by key and time window with a watermark; the same plan serves batch and stream."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), key).agg(F.count("*").alias("n")).select("window.start", "window.end", key, "n")
