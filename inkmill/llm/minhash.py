"""One-permutation MinHash fingerprints with optimal densification.

A text's word-shingle hashes are binned once by their top bits; a bin keeps its
least hash. An empty bin copies from the first full bin of a probe sequence
that depends on the bin's number alone, so two texts copy alike. Of every bin
the fingerprint stores a few low bits of the re-mixed minimum; the share of
equal bins is then corrected for chance equality.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.simhash import shingle_hashes
from inkmill.llm.work import map_batches, same_or_null

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class OnePermutation:
    """Fingerprints of 2**bin_bits bins with ``low_bits`` bits each; low_bits is 1, 2, 4 or 8."""

    def __init__(self, bin_bits: int = 9, low_bits: int = 4, width: int = 5) -> None:
        self.bin_bits, self.low_bits, self.width = bin_bits, low_bits, width
        self.bins = 1 << bin_bits
        self._probes: list[np.ndarray] = []

    def _probe(self, chunk: int) -> np.ndarray:
        """Rows of probe targets for every bin: 8 attempts in the first chunk, 64 in each later one."""
        while len(self._probes) <= chunk:
            k = len(self._probes)
            attempts = np.arange(8 if k == 0 else 64, dtype=np.uint64)[:, None] + np.uint64(0 if k == 0 else 8 + 64 * (k - 1))
            bins = np.arange(self.bins, dtype=np.uint64)[None, :]
            self._probes.append((_mixed((bins << np.uint64(32)) + attempts * _A + _A) >> np.uint64(64 - self.bin_bits)).astype(np.int64))
        return self._probes[chunk]

    def minima(self, text: str | None) -> np.ndarray:
        """The densified least hash of every bin; a text without words counts as one empty shingle."""
        return self._minima(shingle_hashes(text, self.width))

    def _minima(self, h: np.ndarray) -> np.ndarray:
        h = np.sort(h if len(h) else np.array([0xEF46DB3751D8E999], np.uint64))
        of = (h >> np.uint64(64 - self.bin_bits)).astype(np.int64)
        first = np.concatenate([[True], of[1:] != of[:-1]])
        full, value = np.zeros(self.bins, bool), np.zeros(self.bins, np.uint64)
        full[of[first]], value[of[first]] = True, h[first]
        empty, chunk = np.nonzero(~full)[0], 0
        while len(empty):
            probe = self._probe(chunk)[:, empty]
            hit = full[probe]
            found = hit.any(0)
            value[empty[found]] = value[probe[hit.argmax(0)[found], found]]
            empty, chunk = empty[~found], chunk + 1
        return value

    def fingerprint(self, text: str | None) -> np.ndarray:
        """The low bits of every bin, one bin an element."""
        return self.from_hashes(shingle_hashes(text, self.width))

    def from_hashes(self, h: np.ndarray) -> np.ndarray:
        """The fingerprint from shingle hashes that are at hand."""
        return (_mixed(self._minima(h)) & np.uint64((1 << self.low_bits) - 1)).astype(np.uint8)

    def packed(self, fp: np.ndarray) -> bytes:
        bits = np.unpackbits(fp[:, None], axis=1)[:, 8 - self.low_bits :]
        return np.packbits(bits.ravel()).tobytes()

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """Estimate of the shingle sets' Jaccard similarity, corrected for bins that are equal by chance."""
        chance = 0.5**self.low_bits
        return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: OnePermutation | None = None) -> DataFrame:
    """(id, fingerprint binary) of every row; a map over the scan.

    Null, empty and blank texts share one fingerprint; equal texts have equal
    ones; repeated rows and null ids are kept; extra columns are ignored; an
    empty table gives an empty table.
    """
    scheme = scheme or OnePermutation()

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = [scheme.packed(scheme.fingerprint(t)) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fps, pa.binary())], ["id", "fingerprint"])

    return map_batches(same_or_null(docs, id_col, text_col), kernel, "id long, fingerprint binary")


#: Size of a range's texts as they are stored, and the most ranges that the driver lists.
RANGE_BYTES, MOST_RANGES = 64 << 20, 100_000


@dataclass(frozen=True)
class Ranges:
    """Ranges of descending ids. An id that quantiles name more than once fills ranges of its own, by the hash of its texts; so do null ids, last."""

    cuts: np.ndarray  # distinct quantiles, ascending
    many: np.ndarray  # how many quantiles are equal to each
    nulls: int  # ranges of null ids

    @property
    def first(self) -> np.ndarray:
        """Number, from the low end, of the range that ends at each cut, and of the last."""
        return np.concatenate([[0], np.cumsum(1 + np.where(self.many > 1, self.many, 0))])

    def number(self, ids: np.ndarray, null: np.ndarray, h: np.ndarray | None) -> np.ndarray:
        """The range of every row. ``h``: signed 64-bit hashes of the texts; without them shared ids are put at their first range."""
        first, at = self.first, np.searchsorted(self.cuts, ids, side="left")
        share = np.zeros(len(ids)) if h is None else ((h.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(11)) / float(1 << 53)
        near = np.minimum(at, max(0, len(self.cuts) - 1))
        many = np.where((at < len(self.cuts)) & (self.cuts[near] == ids), self.many[near], 0) if len(self.cuts) else np.zeros(len(ids), np.int64)
        low = first[at] + np.where(many > 1, many - (share * many).astype(np.int64), 0)
        return np.where(null, first[-1] + 1 + (share * self.nulls).astype(np.int64), first[-1] - low).astype(np.int32)

    @property
    def shared(self) -> list[int]:
        return self.cuts[self.many > 1].tolist()

    @property
    def total(self) -> int:
        return int(self.first[-1]) + 1 + self.nulls


def ranges_of(rows: DataFrame, parts: int) -> Ranges:
    """About ``parts`` ranges of the column id, of about equal numbers of rows."""
    shares = [k / parts for k in range(1, parts)] or [0.5]
    quantiles = F.percentile_approx("id", F.array(*map(F.lit, shares)), F.lit(max(10_000, 10 * parts)))
    found = rows.agg(quantiles.alias("q"), F.count("*").alias("n"), F.count("id").alias("known")).first()
    cuts, many = np.unique(np.array(found.q if found.q and parts > 1 else [], np.int64), return_counts=True)
    return Ranges(cuts, many, max(1, -(-parts * (found.n - found.known) // max(found.n, 1))))


def in_order(docs: DataFrame, id_col: str, text_col: str, parts: int | None = None) -> DataFrame:
    """Rows by descending id in ranges, a range a task, each followed by the first row of the range after it.

    Columns: part, halo (0, or 1 for that extra row, which closes its part),
    id, text. Ids that are null come last; equal ids go by a hash of the text,
    then by the text. The last range is closed by the very first row. The ids
    are read first; texts are read and shuffled once, except that the texts of
    ids which fill whole ranges are hashed beforehand. The driver sees two
    numbers per range; there are about ``parts`` ranges, by default as many as
    RANGE_BYTES of stored size give, at least ``spark.sql.shuffle.partitions``.
    """
    spark = docs.sparkSession
    if parts is None:
        stored = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        parts = min(MOST_RANGES, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored // RANGE_BYTES)))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ranges = ranges_of(rows, parts)

    @F.pandas_udf("int")
    def number(ids: pd.Series, null: pd.Series) -> pd.Series:
        return pd.Series(ranges.number(ids.to_numpy(), null.to_numpy(), None))

    @F.pandas_udf("int")
    def number_by_hash(ids: pd.Series, null: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(ranges.number(ids.to_numpy(), null.to_numpy(), h.to_numpy()))

    known = F.coalesce("id", F.lit(0)), F.col("id").isNull()  # no null reaches pandas, which would turn ids into doubles
    alike = F.coalesce(F.col("id").isin(ranges.shared), F.lit(True)) if ranges.shared else F.col("id").isNull()
    tops = {r.part: (r.top, 0) for r in rows.where(~alike).groupBy(number(*known).alias("part")).agg(F.max("id").alias("top")).collect()}
    hashed = rows.where(alike).select("id", F.xxhash64("text").alias("h"))
    tops |= {r.part: (r.id, r.h) for r in hashed.groupBy(number_by_hash(*known, "h").alias("part")).agg(F.max("id").alias("id"), F.min("h").alias("h")).collect()}
    order = sorted(tops)
    owner, top, least = np.full(ranges.total, -1, np.int32), np.zeros(ranges.total, np.int64), np.zeros(ranges.total, np.int64)
    by_hash = np.zeros(ranges.total, bool)
    for k, part in enumerate(order):
        owner[part], top[part], least[part] = order[k - 1], tops[part][0] or 0, tops[part][1]
    first = ranges.first
    for j in np.nonzero(ranges.many > 1)[0].tolist():
        by_hash[first[-1] - first[j] - int(ranges.many[j]) : first[-1] - first[j]] = True
    by_hash[first[-1] + 1 :] = True

    @F.pandas_udf("part int, owner int")
    def place(ids: pd.Series, null: pd.Series, h: pd.Series) -> pd.DataFrame:
        part = ranges.number(ids.to_numpy(), null.to_numpy(), h.to_numpy())
        heads = np.where(by_hash[part], h.to_numpy() == least[part], ids.to_numpy() == top[part])
        return pd.DataFrame({"part": part, "owner": np.where(heads, owner[part], -1)})

    placed = rows.withColumn("h", F.xxhash64("text")).withColumn("at", place(*known, "h"))
    own, halo = F.struct(F.col("at.part").alias("part"), F.lit(0).alias("halo")), F.struct(F.col("at.owner").alias("part"), F.lit(1).alias("halo"))
    sent = placed.select(F.explode(F.when(F.col("at.owner") >= 0, F.array(own, halo)).otherwise(F.array(own))).alias("to"), "id", "h", "text").select("to.part", "to.halo", "id", "h", "text")
    return sent.repartitionById(ranges.total, "part").sortWithinPartitions("part", "halo", F.col("id").desc_nulls_last(), "h", "text").select("part", "halo", "id", "text")


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scheme: OnePermutation | None = None, parts: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited text, whose last third is taken from the next document by descending id.

    The last floor(n/3) of a text's n code points are replaced by the first as
    many (or all) of the next text; after the last comes the first. Returns id,
    n_chars, edited_sha256, fingerprint and edited_fingerprint (hex),
    near_edited, near_next. Null texts count as empty; null ids come last in
    order, equal ids and null ids go by a hash of the text; an only row is its
    own next. Rows that repeat id and text follow each other in one task.
    Extra columns are ignored; an empty table gives an empty table.
    """
    scheme = scheme or OnePermutation()
    ordered = in_order(docs, id_col, text_col, parts)
    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # part, id, text, fingerprint of the row whose next is awaited
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: list[list] = [[] for _ in range(7)]
                for part, halo, doc, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    if halo and (not held or held[0] != part):
                        continue  # a shared id gives several such rows, of which the first closes the part
                    fp = scheme.fingerprint(text)
                    if held and held[0] == part:
                        _, held_id, held_text, held_fp = held
                        n = len(held_text)
                        edited = held_text[: n - n // 3] + text[: n // 3]
                        edited_fp = scheme.fingerprint(edited)
                        row = (held_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), scheme.packed(held_fp).hex(), scheme.packed(edited_fp).hex(), scheme.likeness(held_fp, edited_fp), scheme.likeness(held_fp, fp))
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                    held = None if halo else (part, doc, text, fp)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                names = [x.split()[0] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return ordered.mapInArrow(run, schema)
