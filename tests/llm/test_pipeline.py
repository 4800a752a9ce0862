import os

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from inkmill.llm.kneser_ney import classify
from inkmill.llm.queries import TOKENIZER, held_out, trusted_ids
from inkmill.llm.toxicity import Settings, features, fit
from inkmill.llm.work import materialise, release
from inkmill.operators.work import shared_folder
from tests.llm.test_simhash import jaccards, link

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["start"] = docs
    for name, stage in cp.STAGES:
        docs = materialise(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(stages):
    for name, _ in cp.STAGES[:-1]:
        assert stages[name].columns == stages["start"].columns
        assert stages[name].dtypes == stages["start"].dtypes


def test_quality(spark, stages):
    judged = classify(stages["start"], trusted_ids(spark.read.parquet(f"{SF}/labels.parquet"))).collect()
    assert set(rows(stages["quality"])) == {r.id for r in judged if r.keep}
    assert len(judged) * 0.7 < stages["quality"].count() < len(judged)


def test_toxicity(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bias, idx, w = fit(stages["quality"], labels.where(~held_out("doc_id")))
    weights = dict(zip(idx.tolist(), w.tolist(), strict=True))
    want = {i for i, r in rows(stages["quality"]).items() if bias + sum(weights.get(f, 0.0) for f in features(r.text, Settings()).tolist()) < 0}
    assert set(rows(stages["toxicity"])) == want and len(want) < stages["quality"].count()


def test_near_duplicates(stages):
    """Exactly the smallest id of every group of pairs at 0.8 or more, by all pairs of whole texts."""
    before, kept = rows(stages["toxicity"]), stages["near_duplicates"].collect()
    groups = link([p for p, j in jaccards(before).items() if j >= 0.8])
    gone = {i for g in groups for i in g if i != min(g)}
    assert len(gone) > 20 and sorted(r.doc_id for r in kept) == sorted(set(before) - gone)
    assert all(before[r.doc_id] == r for r in kept)


def test_mixing(stages):
    before, got = rows(stages["near_duplicates"]), {}
    for r in stages["mixing"].collect():
        assert before[r.doc_id] == r
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert max(got.values()) <= 3
    size = {i: len(r.text.split()) for i, r in before.items()}
    names = sorted({r.source for r in before.values()})
    total, weight = sum(size.values()), {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    for s in names:
        of = [i for i in before if before[i].source == s]
        words, have = sum(size[i] * got.get(i, 0) for i in of), sum(size[i] for i in of)
        want = min(3 * have, total * weight[s] / sum(weight.values()))
        assert abs(words - want) <= max(size[i] for i in of) + 0.25 * want


def test_packing(stages):
    t = Tokenizer.from_file(TOKENIZER[0])
    mixed = stages["mixing"].collect()
    ids = {r.doc_id: [*t.encode(r.text, add_special_tokens=False).ids, 0] for r in mixed}
    windows = sorted(stages["packing"].collect())
    total = sum(len(ids[r.doc_id]) for r in mixed)
    assert [r.sequence_id for r in windows] == list(range(-(-total // 1024))) and sum(r.n_tokens for r in windows) == total
    for r in windows:
        assert [x for p in r.pieces for x in ids[p.doc_id][p.start : p.start + p.length]] == r.ids[: r.n_tokens]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, id int, `meta.v` string, _key1 long"


def tables(spark, at, docs, labels):
    spark.createDataFrame(docs, DOCS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_one_row_of_each_group_stays(spark):
    """Repeated ids with other texts, ids that are null, rows that are equal throughout, columns with dots and clashing names."""
    long = " ".join(f"w{i}" for i in range(300))
    extra = (5, "m", 1)
    docs = [
        (3, long, "en", "a", 0, *extra),
        (3, long, "en", "a", 0, *extra),
        (3, "another text under the same id", "en", "a", 0, *extra),
        (8, "another text under the same id", "en", "a", 0, *extra),
        (4, long + " end", "en", "a", 0, *extra),
        (None, long, "en", "a", 0, *extra),
        (None, "only without an id", "en", "a", 0, *extra),
        (None, "only without an id", "en", "a", 0, *extra),
        (None, "only without an id", "de", "a", 0, *extra),
        (6, None, None, None, None, None, None, None),
        (7, " ", None, None, None, None, None, None),
    ]
    table = spark.createDataFrame(docs, DOCS)
    found = [cp.near_duplicates(spark, table.repartition(n), "").collect() for n in (1, 7)]
    assert found[0] and sorted(found[0], key=repr) == sorted(found[1], key=repr)
    got = sorted(((r.doc_id, (r.text or "")[:12]) for r in found[0]), key=repr)
    assert got == sorted([(3, long[:12]), (3, "another text"), (6, ""), (None, "only without")], key=repr)
    assert cp.near_duplicates(spark, table, "").columns == table.columns


def test_run_and_edges(spark, tmp_path):
    release()
    long = "word " * 50000
    docs = [(1, None, "en", None, 0, 5, None, 1), (2, "", None, "a", 0, 5, "x", 1), (None, "a b c", "en", "a", 5, 5, "x", 2), (3, "a b c", "en", "b", 5, 5, "x", 2), (3, "a b c", "en", "b", 5, 5, "x", 2), (4, long, "de", "b", 250000, 5, None, None)]
    some, none = (tables(spark, tmp_path / name, keep, [(3, 1, 0), (4, None, None), (None, 1, 1)][: len(keep)]) for name, keep in (("some", docs), ("none", docs[:0])))
    assert cp.run(spark, none).collect() == []
    t = Tokenizer.from_file(TOKENIZER[0])
    size = {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in ((1, None), (3, "a b c"), (4, long))}
    windows = cp.run(spark, some).collect()
    times = {i: sum(p.length for r in windows for p in r.pieces if p.doc_id == i) / size[i] for i in size}
    # null and empty texts are copies and mix as nothing; source b holds the words and takes all of them
    assert times[3] in (1, 2) and times[4] in (1, 2) and sum(r.n_tokens for r in windows) == sum(size[i] * times[i] for i in size)
    assert all(r.ids[:n] for r in windows for n in [r.n_tokens])
    assert sorted(windows) == sorted(cp.run(spark, some).collect())
    release()
    at = shared_folder(spark)
    assert not os.path.isdir(at) or os.listdir(at) == []
