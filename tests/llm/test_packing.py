import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from inkmill.llm.packing import encoder, pack, pack_sequences, pieces, sequences, tokenised
from inkmill.llm.queries import QUERIES, TOKENIZER

WINDOW = 1024


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(TOKENIZER[0])
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("text", ["", "a b", "x <|endoftext|> y", " " * 20000 + "a", "\n" * 9000, "é 漢字 😀\x00", "ab" * 100000, "don't we'll   go\t\n x"])
def test_encoder_gives_the_tokenizers_ids(plain, text):
    assert [*encoder(*TOKENIZER)(text), 0] == plain(text)


def test_encoder_on_random_unicode(plain):
    rng = np.random.default_rng(11)
    encode = encoder(*TOKENIZER)
    ranges = [(0, 128), (32, 127), (0x80, 0x250), (0x300, 0x370), (0x590, 0x700), (0x900, 0xE80), (0x2000, 0x2100), (0x3040, 0x9FFF), (0xAC00, 0xD7A0), (0xFB00, 0xFFFF), (0x1F300, 0x1FB00), (0xE0000, 0xE0080)]
    for _ in range(600):
        spans = [ranges[k] for k in rng.integers(0, len(ranges), 4)]
        codes = [int(rng.integers(*spans[k])) for k in rng.integers(0, 4, rng.integers(1, 80))]
        text = "".join(chr(c) for c in codes if not 0xD800 <= c < 0xE000) + " \t\n"[rng.integers(0, 3)] * int(rng.integers(0, 5)) + "'ll 123 tail"
        assert [*encode(text), 0] == plain(text)


def check(rows, texts, plain, window):
    ids = {i: plain(t) for i, t in texts.items()}
    by_seq, seen = {}, {i: [] for i in texts}
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(piece) == r.ids_crc32 and r.length > 0
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        seen[r.doc_id].append((r.start, r.length))
    for i, spans in seen.items():
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        assert at == len(ids[i])
    total = sum(map(len, ids.values()))
    assert sorted(by_seq) == list(range(-(-total // window)))
    for k, spans in by_seq.items():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == (window if k < total // window else total % window)


def test_query_over_whole_table(spark, sf, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(QUERIES["op2_packing"](spark, sf).collect(), texts, plain, WINDOW)


def test_many_parts_and_round_trip(spark, sf, plain):
    docs = spark.read.parquet(f"{sf}/documents.parquet").repartition(7, "doc_id")
    tokens = tokenised(docs, "doc_id", "text", *TOKENIZER)
    texts = {r.doc_id: r.text for r in docs.collect()}
    cut = pieces(tokens, 64).withColumnRenamed("id", "doc_id").collect()
    check(cut, texts, plain, 64)
    whole = sorted(sequences(tokens, 64).collect())
    for r in whole[:-1]:
        assert r.n_tokens == len(r.ids) == 64
    stream = {(p.sequence_id, p.offset): plain(texts[p.doc_id])[p.start : p.start + p.length] for p in cut}
    for r in whole:
        want = [x for (k, _), ids in sorted(stream.items()) if k == r.sequence_id for x in ids]
        assert list(r.ids[: r.n_tokens]) == want
    held = sorted((r.sequence_id, p.offset, p.id, p.start, p.length) for r in whole for p in r.pieces)
    assert held == sorted((p.sequence_id, p.offset, p.doc_id, p.start, p.length) for p in cut)
    last = whole[-1].n_tokens
    assert len(whole[-1].ids) == (last if last & (last - 1) == 0 else 64)


def test_edge_rows(spark, plain):
    rows = [(1, None, "a"), (2, "", "b"), (None, "x y", "c"), (3, "word " * 60000, "d"), (3, "again", "d"), (3, "again", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").coalesce(1)
    got = pack(docs, "doc_id", "text", *TOKENIZER).collect()
    assert sum(r.length for r in got) == sum(len(plain(t)) for _, t, _ in rows)
    assert {r.doc_tokens for r in got if r.id in (1, 2)} == {1}
    assert pack(docs.limit(0), "doc_id", "text", *TOKENIZER).collect() == []
    windows = pack_sequences(docs, "doc_id", "text", *TOKENIZER).collect()
    assert sum(r.n_tokens for r in windows) == sum(r.length for r in got) == sum(p.length for r in windows for p in r.pieces)
    assert pack_sequences(docs.limit(0), "doc_id", "text", *TOKENIZER).collect() == []


def test_whole_windows_are_read_as_written(spark):
    texts = {i: "word " * (37 * i % 400) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = pack_sequences(docs, "doc_id", "text", *TOKENIZER, window=128)
    assert "MapInArrow" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.dtypes == [("sequence_id", "bigint"), ("n_tokens", "int"), ("ids", "array<int>"), ("pieces", "array<struct<id:bigint,start:bigint,length:bigint,offset:bigint>>")]
