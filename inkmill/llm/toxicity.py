"""Toxicity scores from an FTRL-proximal logistic regression.

Features are hashed: words, six-byte word stems, word pairs and pairs that
skip one word, each counted once a text. Training runs on the executors in
shards of a bounded number of labelled rows (a seeded sample if there are
more); every coordinate has its own learning rate, and the L1 term leaves few
weights other than zero. The mean of the shards' weights, a sparse vector of
at most 2**bits entries, is what the scoring scan carries with it. Each shard
sets the scale of its log odds on a fifth of its rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.work import give_back, lean, materialise, same_or_null, scoped

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0  # for up to 3,000 rows; beyond, it grows as their root, as the noise of a sum of gradients does
    l2: float = 0.1
    epochs: int = 6
    stem: int = 6
    shard_rows: int = 5_000  # labelled rows a training task holds
    max_shards: int = 8  # so at most 40,000 labelled rows are learnt from
    seed: int = 4


def features(text: str | None, s: Settings) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    words = _WORD.findall((text or "").lower().encode("utf-8", "surrogatepass"))
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(crc32, words), np.uint64, len(words))
    stems = np.fromiter((crc32(w[: s.stem]) for w in words), np.uint64, len(words))
    parts = [h, stems + np.uint64(1 << 40), (h[:-1] << np.uint64(21)) + h[1:] + np.uint64(1 << 60), (h[:-2] << np.uint64(23)) + h[2:] + np.uint64(3 << 60)]
    return np.unique((np.concatenate(parts) * _MIX) >> np.uint64(64 - s.bits)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, int]], s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """FTRL-proximal over the rows in their order: bias, feature numbers, weights (only those that are not zero)."""
    size = (1 << s.bits) + 1  # the last coordinate is the bias, which L1 spares
    z, n = np.zeros(size), np.zeros(size)
    sparse = s.l1 * max(1.0, len(rows) / 3000) ** 0.5

    def weight(i: np.ndarray) -> np.ndarray:
        l1 = np.where(i == size - 1, 0.0, sparse)
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((s.beta + np.sqrt(n[i])) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for idx, label in rows:
            i = np.append(idx, size - 1)
            w = weight(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / s.alpha * w
            n[i] += g * g
    w = weight(np.arange(size))
    found = np.nonzero(w[:-1])[0]
    return float(w[-1]), found, w[found]


def platt(raw: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and offset that make raw scores log odds, with smoothed targets; by Newton steps on the logistic loss."""
    yes, no = label.sum(), len(label) - label.sum()
    target = np.where(label == 1, (yes + 1) / (yes + 2), 1 / (no + 2))
    x, beta = np.column_stack([raw, np.ones(len(raw))]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * (beta - [1.0, 0.0]))
        beta = beta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.1)), float(beta[1])


def train_calibrated(rows: list[tuple[np.ndarray, int]], s: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """``train`` on all rows, its log odds scaled as four fifths of the rows tell of the last fifth.

    L1 draws all scores towards the bias, so that 0.5 would be too high a bar;
    with fewer than five held rows of a class, the scores stay as they are.
    """
    held, label = rows[::5], np.array([y for _, y in rows[::5]])
    bias, idx, w = train(rows, s)
    if min(label.sum(), len(label) - label.sum()) < 5:
        return bias, idx, w
    b, i, v = train([r for k, r in enumerate(rows) if k % 5], s)
    weights = np.zeros(1 << s.bits)
    weights[i] = v
    scale, offset = platt(np.array([b + weights[x].sum() for x, _ in held]), label)
    return scale * bias + offset, idx, scale * w


@scoped
def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", settings: Settings = Settings()) -> tuple[float, np.ndarray, np.ndarray]:
    """Learn from the labelled rows of ``docs``: bias, feature numbers, weights.

    ``labels``: id, label 0 or 1; rows with a null or another label are left
    out, as are ids in ``docs`` without a label. At most ``shard_rows *
    max_shards`` labelled ids are used, chosen by a seeded hash of the id;
    repeated ids count once, with their largest label.
    """
    s, spark = settings, docs.sparkSession
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    known = materialise(known.withColumn("h", F.xxhash64(F.lit(s.seed), "id")), "labels")
    n, limit = known.count(), s.shard_rows * s.max_shards
    if not n:
        return -20.0, np.empty(0, np.int64), np.empty(0)
    if n > limit:  # keep the hashes under the share that is wanted, a little less for the spread
        known = known.where(F.col("h") < int((0.97 * limit / n * 2 - 1) * (1 << 63)))
    shards = max(1, min(s.max_shards, -(-n // s.shard_rows)))
    rows = same_or_null(docs, id_col, text_col).toDF("id", "text").join(F.broadcast(known), "id").select("id", "label", "h", "text", F.pmod("h", F.lit(shards)).alias("shard"))

    def shard_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, of = None, []

        def model() -> pa.RecordBatch:
            bias, idx, w = train_calibrated(of, s)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([bias], pa.float64()), pa.array([idx], pa.list_(pa.int64())), pa.array([w], pa.list_(pa.float64()))], ["shard", "bias", "idx", "w"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                label, text, shard = (c.to_pylist() for c in batch.slice(at, 64).columns)
                for y, t, k in zip(label, text, shard, strict=True):
                    if k != now and of:
                        yield model()
                        of = []
                    now = k
                    of.append((features(t, s).astype(np.int32), y))
        if of:
            yield model()

    # keys that the hash sends to partitions of their own, so that no task holds two shards while another holds none
    numbers = spark.range(64 * shards).select("id", F.pmod(F.hash("id"), F.lit(shards)).alias("p")).groupBy("p").agg(F.min("id").alias("id")).orderBy("p").collect()
    keys = F.array(*[F.lit(r.id) for r in numbers])
    rows = rows.withColumn("shard", F.element_at(keys, (F.col("shard") % len(numbers) + 1).cast("int")))
    ready = rows.repartition(shards, "shard").sortWithinPartitions("shard", "h", "id", "text").select("label", "text", "shard")
    models = ready.mapInArrow(lean(shard_model), "shard long, bias double, idx array<long>, w array<double>").collect()
    total = np.zeros(1 << s.bits)
    for m in models:
        total[np.array(m.idx, np.int64)] += np.array(m.w)
    found = np.nonzero(total)[0]
    return sum(m.bias for m in models) / max(1, len(models)), found, total[found] / max(1, len(models))


def score(docs: DataFrame, model: tuple[float, np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, score) of every row: a map over the scan. Null and empty texts score the bias alone."""
    bias, idx, w = model
    idx, w = idx.astype(np.int32), w.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << settings.bits, np.float32)
        weights[idx] = w
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                raw = np.array([bias + float(weights[features(t, settings)].sum(dtype=np.float64)) for t in rows.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(raw, -35, 35))))], ["id", "score"])

    return same_or_null(docs, id_col, text_col).mapInArrow(lean(run), "id long, score double")


def score_column(model: tuple[float, np.ndarray, np.ndarray], settings: Settings = Settings()):
    """The same score as a function of a text column, for plans that keep the rest of the row in the JVM."""
    bias, idx, w = model
    idx, w = idx.astype(np.int32), w.astype(np.float32)

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = np.zeros(1 << settings.bits, np.float32)
        weights[idx] = w
        for part in parts:
            raw = np.array([bias + float(weights[features(t, settings)].sum(dtype=np.float64)) for t in part])
            yield pd.Series(1 / (1 + np.exp(-np.clip(raw, -35, 35))), dtype="float64")
        del weights
        give_back()

    return scores
