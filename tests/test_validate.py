import random

import pytest

from inkmill.operators.validate import gate, grammar, segments, validate

SYMBOLS = [
    (0, "Oligon", "neume", "base", "1", None, None),
    (1, "Klasma", "gorgon", "modifier", ":", {"short": ":", "long": ";", "under": None}, None),
    (2, "Pa", "isson", "modifier", "p", {"short": "p"}, None),
    (3, "PaKey", "key_signature", "key_signature", "vV", None, "segmentStart"),
    (4, "Later", "key_signature", "key_signature", "vV", None, "midOnly"),
    (5, "DhiKey(Down)", "key_signature", "key_signature", "dD", None, "midOnly"),
    (6, "Longest", "key_signature", "key_signature", "dD1", None, None),
    (7, "Siopi1", "rest", "rest", "_", None, None),
    (8, "Wide", "neume", "base", "22", None, None),
]


@pytest.fixture(scope="module")
def rules(spark):
    return grammar(spark.createDataFrame(SYMBOLS, "pos int, icon string, group string, role string, insert string, variants map<string,string>, key_role string"))


def found(spark, rules, *texts):
    rows = spark.createDataFrame([("d", i, t) for i, t in enumerate(texts)], "doc_id string, segment_index int, segment string")
    return sorted((r.segment_index, r.position, r.code) for r in validate(rows, rules).collect())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("vV1:p", []),
        ("1dD1", []),
        ("_", []),
        ("", []),
        (None, []),
        ("￿", [(0, "unknown_char")]),
        ("1~", [(1, "unknown_char")]),
        (":", [(0, "modifier_without_base")]),
        ("1:;", [(2, "duplicate_modifier")]),
        ("1:p;:", [(3, "duplicate_modifier"), (4, "duplicate_modifier")]),
        ("1vV", [(1, "key_signature_role")]),
        ("dD", [(0, "key_signature_role")]),
        ("dD1", []),
        ("22", [(0, "unknown_char"), (1, "unknown_char")]),
        ("😀1\n", [(0, "unknown_char"), (2, "unknown_char")]),
    ],
)
def test_examples(spark, rules, text, want):
    assert found(spark, rules, text) == [(0, *w) for w in want]


def test_segments_of_every_kind(spark, rules):
    plain = spark.createDataFrame([("a", None), ("b", "x")], "doc_id string, c string")
    assert [tuple(r) for r in segments(plain, "doc_id", "c").collect()] == [("a", 0, ""), ("b", 0, "x")]
    listed = spark.createDataFrame([("a", ["1", None])], "doc_id string, c array<string>")
    assert [tuple(r) for r in segments(listed, "doc_id", "c").collect()] == [("a", 0, "1"), ("a", 1, "")]
    nested = spark.createDataFrame([("a", [None, ("1",), (None,), ("￿",)])], "doc_id string, c array<struct<composition:string>>")
    rows = segments(nested, "doc_id", "c")
    assert [(r.segment_index, r.position, r.code) for r in validate(rows, rules).collect()] == [(2, 0, "unknown_char")]
    ok = gate(nested, validate(rows, rules), 1).first()
    assert (ok.files, ok.bad, ok.passed) == (1, 1, False)


def slow(text, rules):
    out, i = [], 0
    keys = sorted(rules.keys, key=lambda k: -len(k))
    while i < len(text):
        key = next((k for k in keys if text.startswith(k, i)), None)
        if key:
            role = rules.keys[key][1]
            if (role == "segmentStart" and i) or (role == "midOnly" and not i):
                out.append((i, "key_signature_role"))
            i += len(key)
        elif text[i] in rules.bases:
            i, seen = i + 1, set()
            while i < len(text) and text[i] in rules.modifiers:
                if rules.modifiers[text[i]] in seen:
                    out.append((i, "duplicate_modifier"))
                seen.add(rules.modifiers[text[i]])
                i += 1
        else:
            if text[i] not in rules.atoms:
                out.append((i, "modifier_without_base" if text[i] in rules.modifiers else "unknown_char"))
            i += 1
    return out


def test_against_an_automaton(spark, rules):
    rng = random.Random(11)
    texts = ["".join(rng.choice("11:;pvVdD_x\n") for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["1" * 100000 + ":;" + "_" * 100000]
    want = sorted((k, *e) for k, t in enumerate(texts) for e in slow(t, rules))
    assert found(spark, rules, *texts) == want


def test_messages_and_empty_tables(spark, rules):
    rows = spark.createDataFrame([("d", 0, "1:;~")], "doc_id string, segment_index int, segment string")
    assert [r.message for r in validate(rows, rules).collect()] == ["Duplicate modifier Klasma on the same base neume.", "Unknown OCR composition character '~'."]
    assert validate(rows.limit(0), rules).collect() == []
