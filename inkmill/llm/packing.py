"""Concatenate-and-cut packing of tokenised documents into fixed windows.

Pass 1 tokenises at the scan and writes, for every document, its ids and the
ids before it within its scan task. The totals of the tasks (one number each)
give each task's place in the whole stream by a prefix sum. Pass 2 cuts the
stream every ``window`` ids: a document's pieces follow from its global
offset alone, so no text and no ids are shuffled. Only the incomplete windows
at the ends of a run of rows are boundary records that meet in a small shuffle.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.work import lean, materialise, same_or_null, scoped

#: Longest run of white space that goes through the rank encoder, whose matcher recurses on such runs.
_LONG_SPACE = re.compile(r"\s{4096}")


def encoder(tokenizer_json: str, ranks_file: str | None = None):
    """text -> uint32 ids, as the tokenizer file gives them without special tokens.

    ``ranks_file`` holds the same vocabulary as byte ranks; with it, ordinary
    texts take a faster encoder with equal ids. Texts that hold an added token's
    string or a very long run of white space always take the tokenizer itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"

    @functools.cache  # most tasks have no text that takes it
    def whole():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(tokenizer_json)

    def by_tokenizer(text: str) -> np.ndarray:
        return np.array(whole().encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    if ranks_file is None:
        return by_tokenizer
    import base64
    import json

    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    ordinary = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    with open(tokenizer_json, encoding="utf-8") as f:
        added = re.compile("|".join(re.escape(t["content"]) for t in json.load(f).get("added_tokens") or []) or r"(?!)")

    def encode(text: str) -> np.ndarray:
        if added.search(text) or _LONG_SPACE.search(text):
            return by_tokenizer(text)
        return np.array(ordinary(text), dtype=np.uint32)

    return encode


def tokenised(docs: DataFrame, id_col: str, text_col: str, tokenizer_json: str, ranks_file: str | None = None, end_id: int = 0) -> DataFrame:
    """Pass 1, written to the shared folder: part, id, doc_tokens, local_start, ids (little-endian uint32, ``end_id`` last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(tokenizer_json, ranks_file), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                ids = [np.append(encode(t or ""), np.uint32(end_id)) for t in rows.column(1).to_pylist()]
                sizes = [len(x) for x in ids]
                starts = [before, *(before + x for x in accumulate(sizes))]
                before = starts.pop()
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int32()), rows.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(starts, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], ["part", "id", "doc_tokens", "local_start", "ids"])

    table = same_or_null(docs, id_col, text_col).mapInArrow(lean(run), "part int, id long, doc_tokens long, local_start long, ids binary")
    return materialise(table, "tokens")


def part_offsets(tokens: DataFrame) -> dict[int, int]:
    """First global offset of every scan task: a prefix sum over one total per task, which is all that reaches the driver."""
    totals = sorted(tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect())
    return dict(zip([r.part for r in totals], accumulate([r.n for r in totals], initial=0), strict=False))


def pieces(tokens: DataFrame, window: int = 1024, with_ids: bool = False) -> DataFrame:
    """Pass 2: one row per piece of a document in a window.

    Columns: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and,
    if asked for, ids (little-endian uint32).
    """
    offsets = part_offsets(tokens)
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: list[list] = [[] for _ in range(8)]
                part, ids_of, size_of, start_of, raw = (c.to_pylist() for c in batch.slice(at, 256).columns)
                for p, doc, size, local, ids in zip(part, ids_of, size_of, start_of, raw, strict=True):
                    first = offsets[p] + local
                    cuts = [0, *range(window - first % window, size, window), size]
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        piece = ids[4 * a : 4 * b]
                        for column, value in zip(out, (doc, a, b - a, zlib.crc32(piece), size, (first + a) // window, (first + a) % window, piece), strict=True):
                            column.append(value)
                kinds = [pa.int64()] * 7 + [pa.binary()]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
                n = 8 if with_ids else 7
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out[:n], kinds, strict=False)], names[:n])

    return tokens.select("part", "id", "doc_tokens", "local_start", "ids").mapInArrow(lean(run), schema)


_PIECE = pa.struct([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("offset", pa.int64())])


def sequences(tokens: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """The packed windows: sequence_id, n_tokens (without padding), ids array<int>, pieces array<struct<id, start, length, offset>>.

    Windows that a run of consecutive rows fills are complete at once and are
    read as they were written; the fragments at a run's ends are boundary
    records that are joined by sequence_id. The last window is padded to ``window``, except where its
    length is a power of two.
    """
    offsets = part_offsets(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, size, pieces, raw = None, 0, [], []  # the fragment that grows: its window, its ids so far

        def fragment() -> tuple:
            return now, pieces[0][3], pieces, b"".join(raw)

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            a, b, c, d = zip(*found, strict=True) if found else ((), (), (), ())
            ends = pa.array(accumulate([len(x) // 4 for x in d], initial=0), pa.int32())
            ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(d), "<i4"), pa.int32()))
            columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([len(x) // 4 for x in d], pa.int32()), ids, pa.array(c, pa.list_(_PIECE))]
            return pa.RecordBatch.from_arrays(columns, ["sequence_id", "offset", "n_tokens", "ids", "pieces"])

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                found = []
                part, docs, sizes, start_of, all_ids = (c.to_pylist() for c in batch.slice(i, 256).columns)
                for p, doc, total, local, ids in zip(part, docs, sizes, start_of, all_ids, strict=True):
                    first = offsets[p] + local
                    cuts = [0, *range(window - first % window, total, window), total]
                    for x, y in zip(cuts, cuts[1:], strict=False):
                        at, offset = divmod(first + x, window)
                        if pieces and (at != now or offset != pieces[0][3] + size):
                            found.append(fragment())
                            size, pieces, raw = 0, [], []
                        now = at
                        pieces.append((doc, x, y - x, offset))
                        raw.append(ids[4 * x : 4 * y])
                        size += y - x
                yield batch_of(found)
        if pieces:
            yield batch_of([fragment()])

    kind = "n_tokens int, ids array<int>, pieces array<struct<id:long,start:long,length:long,offset:long>>"
    cuts = materialise(tokens.select("part", "id", "doc_tokens", "local_start", "ids").mapInArrow(lean(run), f"sequence_id long, offset long, {kind}"), "windows")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "pieces")))
    ends = cuts.where(F.col("n_tokens") < window).groupBy("sequence_id").agg(F.sum("n_tokens").cast("int").alias("n_tokens"), parts.alias("parts"))
    ids, n = F.flatten(F.transform("parts", lambda x: x["ids"])), F.col("n_tokens")
    padded = F.when(n.bitwiseAND(n - 1) == 0, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(window) - n)))
    joined = ends.select("sequence_id", "n_tokens", padded.alias("ids"), F.flatten(F.transform("parts", lambda x: x["pieces"])).alias("pieces"))
    return cuts.where(F.col("n_tokens") == window).select("sequence_id", "n_tokens", "ids", "pieces").unionByName(joined)


@scoped
def pack_sequences(docs: DataFrame, id_col: str, text_col: str, tokenizer_json: str, ranks_file: str | None = None, window: int = 1024, end_id: int = 0) -> DataFrame:
    """The windows themselves, as ``sequences`` gives them; nulls, repeats and empty tables are as in ``pack``."""
    return sequences(tokenised(docs, id_col, text_col, tokenizer_json, ranks_file, end_id), window)


@scoped
def pack(docs: DataFrame, id_col: str, text_col: str, tokenizer_json: str, ranks_file: str | None = None, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of every document in windows of ``window`` ids, without padding but in the last.

    A null text counts as empty and still has its end id; a null id stays null;
    rows with equal ids are packed each on their own, one after the other; texts
    of any length are cut freely. Extra columns are ignored; an empty table
    gives no pieces.
    """
    return pieces(tokenised(docs, id_col, text_col, tokenizer_json, ranks_file, end_id), window)
