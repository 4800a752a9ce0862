"""Perplexity under an interpolated modified Kneser-Ney model of characters.

Texts are gathered at the scan into blocks of some megabytes, one compressed
row each, in a table bucketed by block. Everything that must meet a block later
(which of its texts are trusted, the model's values for the n-grams it holds)
is shuffled to the block's bucket; the texts themselves are never shuffled.

Training counts the n-grams of the trusted texts by block, adds the counts up
by (language, n-gram), and builds the orders from each other with joins that
are sharded by n-gram: continuation counts, context totals, discounts,
interpolation. Each block asks for the n-grams it holds, once each, and is
joined with the answers; no task holds the whole model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.work import broadcast_if_small, discard, give_back, lean, materialise, rows_in, same_or_null, scoped

PAD = 2  # U+0002 stands before a text's first character
_NUL = 0xFFFD  # takes the place of U+0000 in n-grams

_BLOCK = "block long, lang string, ids array<long>, sizes array<int>, texts binary"


def blocks(docs: DataFrame, id_col: str, text_col: str, lang_col: str, block_chars: int, buckets: int) -> DataFrame:
    """The texts in compressed blocks of one language and about ``block_chars`` characters, as a table bucketed by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        number, held, chars = TaskContext.get().partitionId() << 24, {}, {}

        def block(lang: str) -> pa.RecordBatch:
            nonlocal number
            ids, texts = zip(*held.pop(lang), strict=True)
            blob = zstandard.compress("".join(texts).encode("utf-8", "surrogatepass"), 3)
            number += 1
            columns = [pa.array([number - 1], pa.int64()), pa.array([lang]), pa.array([ids], pa.list_(pa.int64())), pa.array([list(map(len, texts))], pa.list_(pa.int32())), pa.array([blob], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["block", "lang", "ids", "sizes", "texts"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for i, t, lang in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    lang = lang or ""
                    held.setdefault(lang, []).append((i, t or ""))
                    chars[lang] = chars.get(lang, 0) + len(t or "")
                    if chars[lang] >= block_chars:
                        yield block(lang)
                        chars[lang] = 0
                    elif sum(chars.values()) >= 2 * block_chars:  # many languages at once: put out the largest
                        most = max(chars, key=chars.get)
                        yield block(most)
                        chars[most] = 0
        for lang in sorted(held):
            yield block(lang)

    return materialise(same_or_null(docs, id_col, text_col, lang_col).mapInArrow(lean(run), _BLOCK), "blocks", buckets, "block")


def grams(codes: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows of 1 to ``order`` symbols as code point matrices, and each position's window number at the full order.

    Windows are numbered by extending the numbers of the shorter ones by a
    symbol, in tables no larger than (distinct windows) x (distinct symbols).
    Positions without a full window to their left have number -1.
    """
    seen = np.zeros(int(codes.max()) + 1, bool)
    seen[codes] = True
    symbols = np.nonzero(seen)[0]
    lookup = (np.cumsum(seen, dtype=np.int32) - 1).astype(np.min_scalar_type(len(symbols)))
    symbol = np.empty(len(codes), lookup.dtype)
    for at in _slices(len(codes)):
        symbol[at] = lookup[codes[at]]
    numbers = np.full(len(codes) + order - 1, -1, np.int32)  # of the window that starts at each position, from order - 1 on
    numbers[order - 1 :] = symbol
    rows = symbols[:, None]
    levels = [rows]
    for k in range(1, order):
        span = len(rows) * len(symbols)
        ids = numbers[order - 1 : len(codes) + order - 1 - k]
        if span <= 1 << 25:
            seen = np.zeros(span, bool)
            for at in _slices(len(ids)):
                ids[at] = ids[at] * len(symbols) + symbol[k:][at]
                seen[ids[at]] = True
            distinct = np.nonzero(seen)[0]
            lookup = np.cumsum(seen, dtype=np.int32) - 1
            for at in _slices(len(ids)):
                ids[at] = lookup[ids[at]]
        else:
            distinct, ids[:] = np.unique(ids.astype(np.int64 if span >= 1 << 31 else np.int32) * len(symbols) + symbol[k:], return_inverse=True)
        rows = np.column_stack([rows[distinct // len(symbols)], symbols[distinct % len(symbols)]])
        levels.append(rows)
    return levels, numbers[: len(codes)]


def _slices(n: int) -> list[slice]:
    """Pieces of a long array, so that what indexing makes of a piece (positions of eight bytes) stays small."""
    return [slice(at, at + (1 << 17)) for at in range(0, n, 1 << 17)]


def _strings(rows: np.ndarray) -> list[str]:
    return np.ascontiguousarray(rows.astype("<u4")).view(f"<U{rows.shape[1]}").ravel().tolist()


def _characters(sizes: list[int], blob: bytes, order: int) -> tuple[np.ndarray, list[int], list[int]]:
    """A block's characters with pads before each text, and where each text starts and stops."""
    import zstandard

    text = zstandard.decompress(blob).decode("utf-8", "surrogatepass")
    ends = np.cumsum(sizes)
    stops = ends + (order - 1) * np.arange(1, len(sizes) + 1)
    codes = np.full(len(text) + (order - 1) * len(sizes), PAD, np.uint32)
    for end, size, stop in zip(ends.tolist(), sizes, stops.tolist(), strict=True):
        part = np.frombuffer(text[end - size : end].encode("utf-32-le", "surrogatepass"), "<u4")
        codes[stop - size : stop] = np.where(part == 0, np.uint32(_NUL), part)
    return codes, (stops - sizes).tolist(), stops.tolist()


def block_grams(table: DataFrame, trusted: DataFrame, order: int) -> DataFrame:
    """(block, lang, gram, n) of every block: its distinct n-grams of all orders, n counting those of full order in trusted texts.

    ``trusted``: ids to learn from. The empty n-gram stands for what lies below order 1.
    """
    ids = table.select("block", F.explode("ids").alias("id"))
    flags = ids.join(trusted.select("id").distinct(), "id").select(F.col("block").alias("at"), "id").distinct()

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        known = set(right.column("id").to_pylist())
        out = [pa.table({"block": pa.array([], pa.int64()), "lang": pa.array([], pa.string()), "gram": pa.array([], pa.string()), "n": pa.array([], pa.int64())})]
        for block, lang, ids, sizes, blob in zip(*(left.column(c).to_pylist() for c in ("block", "lang", "ids", "sizes", "texts")), strict=True):
            codes, starts, stops = _characters(sizes, blob, order)
            levels, number = grams(codes, order) if len(codes) >= order else ([], np.empty(0, np.int64))
            counts = np.zeros(len(levels[-1]) if levels else 0, np.int64)
            real = np.zeros(len(counts), bool)
            for i, a, b in zip(ids, starts, stops, strict=True):
                real[number[a:b]] = True
                if i in known:
                    np.add.at(counts, number[a:b], 1)
            names = [""] + [g for rows in levels[:-1] for g in _strings(rows)]
            n = [0] * len(names) + counts[real].tolist()
            names += _strings(levels[-1][real]) if levels else []
            out.append(pa.table({"block": pa.array([block] * len(names), pa.int64()), "lang": pa.array([lang] * len(names)), "gram": pa.array(names), "n": pa.array(n, pa.int64())}))
            del codes, number, counts, real, names, n
        give_back()
        return pa.concat_tables(out)

    return table.groupBy("block").cogroup(flags.groupBy("at")).applyInArrow(kernel, "block long, lang string, gram string, n long")


def model(counts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, p, back) from (lang, gram, n) of full-order n-grams.

    p is the interpolated probability of the last symbol after the others;
    back is the weight that the n-gram, as a context, leaves to the next lower
    order. The empty n-gram's p is the uniform share of a language's symbols
    and one unknown.
    """
    level, levels = counts.groupBy("lang", "gram").agg(F.sum("n").alias("c")), {}
    levels[order] = level = materialise(level, f"counts{order}")
    for k in range(order - 1, 0, -1):
        levels[k] = level = materialise(level.select("lang", F.substring("gram", 2, k).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("c")), f"counts{k}")
    lower = levels[1].groupBy("lang").agg((1.0 / (F.count("*") + 1)).alias("p")).select("lang", F.lit("").alias("gram"), "p")
    probs, backs = [lower], []
    for k in range(1, order + 1):
        n = levels[k].groupBy("lang").agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)])
        y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
        discounts = [F.when(F.col(f"n{i}") > 0, F.least(F.greatest(i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"), F.lit(0.0)), F.lit(i * 0.95))).otherwise(i * 0.5) for i in (1, 2, 3)]
        cut = F.element_at(F.array(*discounts), F.least("c", F.lit(3)).cast("int"))
        rows = levels[k].join(broadcast_if_small(n), "lang").select("lang", "gram", F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("suffix"), "c", cut.alias("cut"))
        contexts = rows.groupBy("lang", "context").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("back"))
        lower = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
        p = (F.col("c") - F.col("cut")) / F.col("total") + F.col("back") * F.col("below")
        lower = materialise(rows.join(contexts, ["lang", "context"]).join(lower, ["lang", "suffix"]).select("lang", "gram", p.alias("p")), f"probs{k}")
        probs.append(lower)
        backs.append(contexts.select("lang", F.col("context").alias("gram"), "back"))
    values = [t.select("lang", "gram", "p", F.lit(None).cast("double").alias("back")) for t in probs] + [t.select("lang", "gram", F.lit(None).cast("double").alias("p"), "back") for t in backs]
    both = values[0]
    for t in values[1:]:
        both = both.unionByName(t)
    values = materialise(both.groupBy("lang", "gram").agg(F.max("p").alias("p"), F.max("back").alias("back")), "model")
    discard(*levels.values(), *probs[1:])
    return values


def log_probability(gram: str, p: dict, back: dict, memo: dict) -> float:
    """Natural log of the last symbol's probability after the others, backing off where the n-gram was not seen."""
    if gram in memo:
        return memo[gram]
    if gram in p:
        value = float(np.log(p[gram]))
    elif gram:
        value = float(np.log(back.get(gram[:-1], 1.0))) + log_probability(gram[1:], p, back, memo)
    else:
        value = float(np.log(1 / 256))  # a language without any trusted text
    memo[gram] = value
    return value


def perplexities(table: DataFrame, requests: DataFrame, values: DataFrame, order: int) -> DataFrame:
    """(id, lang, n_chars, perplexity) of every text; null for a text without characters."""
    values = values.select("lang", "gram", F.col("p").cast("float"), F.col("back").cast("float"))
    answers = requests.select(F.col("block").alias("at"), "lang", "gram").join(values, ["lang", "gram"]).drop("lang")

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        p, back = {}, {}
        for gram, a, b in zip(*(right.column(c).to_pylist() for c in ("gram", "p", "back")), strict=True):
            if a is not None:
                p[gram] = a
            if b is not None:
                back[gram] = b
        out: list[tuple] = []
        for lang, ids, sizes, blob in zip(*(left.column(c).to_pylist() for c in ("lang", "ids", "sizes", "texts")), strict=True):
            codes, starts, stops = _characters(sizes, blob, order)
            levels, number = grams(codes, order) if len(codes) >= order else ([np.empty((0, order))], np.empty(0, np.int64))
            memo: dict = {}
            logs = np.array([log_probability(g, p, back, memo) for g in _strings(levels[-1])]) if len(levels[-1]) else np.empty(0)
            for i, size, a, b in zip(ids, sizes, starts, stops, strict=True):
                out.append((i, lang, size, float(np.exp(-logs[number[a:b]].mean())) if b > a else None))
            del codes, number, memo, logs
        p, back = {}, {}
        give_back()
        a, b, c, d = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"id": pa.array(a, pa.int64()), "lang": pa.array(b, pa.string()), "n_chars": pa.array(c, pa.int64()), "perplexity": pa.array(d, pa.float64())})

    return table.groupBy("block").cogroup(answers.groupBy("at")).applyInArrow(kernel, "id long, lang string, n_chars long, perplexity double")


@scoped
def score_perplexity(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = 4, block_chars: int = 6_000_000, buckets: int | None = None) -> DataFrame:
    """Perplexity per character of every text under the model of the trusted ones.

    ``trusted``: column id. Returns one row per input row: id, lang (null
    counts as ""), n_chars, perplexity (null for null and empty texts). Each
    language has its own model; one without trusted text gets the same value
    for all characters. Rows with equal ids are scored each on their own, and
    learnt from together if trusted. Extra columns are ignored; an empty table
    gives an empty table.
    """
    spark = docs.sparkSession
    table = blocks(docs, id_col, text_col, lang_col, block_chars, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    requests = materialise(block_grams(table, trusted, order), "grams")
    values = model(requests.where("n > 0"), order)
    scored = materialise(perplexities(table, requests, values, order), "perplexity")
    discard(table, requests, values)
    return scored


@scoped
def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = 4, level: float = 0.999995, least: int = 20) -> DataFrame:
    """Judge every text by its perplexity: id, lang, perplexity, threshold, keep.

    Four fifths of the trusted ids (by CRC-32) train the model; the rest, which
    it has not seen, set each language's threshold: the quantile ``level`` of
    their log perplexities. So high a quantile lies beyond any sample's end, so
    it is carried on from the language's median and 95 % quantile by an
    exponential tail. A language with fewer than ``least`` such texts has its
    own median and the pooled distance of the languages' texts from their
    medians; one without any takes the quantiles of all languages together;
    without any at all, all is kept. Texts without characters are kept. Nulls,
    repeats and empty tables are as in ``score_perplexity``.
    """
    trusted = trusted.select("id").where("id is not null").distinct().withColumn("held", F.crc32(F.col("id").cast("string")) % 5 == 0)
    scored = score_perplexity(docs, trusted.where("not held"), id_col, text_col, lang_col, order)
    held = materialise(scored.where("perplexity is not null").join(trusted.where("held"), "id").select("lang", F.log("perplexity").alias("log")), "held")
    steps = math.log(0.5 / (1 - level), 10)  # of the distance from median to 95 % quantile; an exponential tail loses nine tenths with each
    quantiles = F.percentile_approx("log", F.array(F.lit(0.5), F.lit(0.95)), F.lit(10000))
    by_lang = materialise(held.groupBy("lang").agg(quantiles.alias("q"), F.count("*").alias("n")).select("lang", "n", F.col("q")[0].alias("median"), (F.col("q")[1] - F.col("q")[0]).alias("own")), "quantiles")
    apart = held.join(broadcast_if_small(by_lang), "lang").agg(F.percentile_approx(F.col("log") - F.col("median"), F.lit(0.95), F.lit(10000)).alias("pooled"))
    overall = held.agg(quantiles.alias("q")).select((F.col("q")[0] + steps * (F.col("q")[1] - F.col("q")[0])).alias("overall"))
    out = scored.join(broadcast_if_small(by_lang), "lang", "left").crossJoin(F.broadcast(apart)).crossJoin(F.broadcast(overall))
    threshold = F.exp(F.coalesce(F.col("median") + steps * F.when(F.col("n") >= least, F.col("own")).otherwise(F.col("pooled")), "overall"))
    return out.withColumn("threshold", threshold).select("id", "lang", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("keep"))


@scoped
def without_rejected(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **settings) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, all columns.

    An id under which any text is rejected goes with all its rows; rows with a
    null id stay.
    """
    judged = classify(docs, trusted, id_col, text_col, lang_col, **settings)
    rejected = materialise(judged.where("not keep and id is not null").select(F.col("id").alias(id_col)).distinct(), "rejected")
    return rows_in(docs, rejected, [id_col], keep=False)
