import random

import duckdb
import pytest

from inkmill.llm.chat import collapse, format_chats
from inkmill.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, block int"


def slow_collapse(convs):
    """convs: id -> list of turns."""
    out = {}
    for i, own in convs.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for o in convs.values())
        out[i] = "prefix" if longer else "copy" if any(o == own and j < i for j, o in convs.items()) else "maximal"
    return out


@pytest.mark.parametrize("block_turns", [1, 3, 256])
def test_against_all_pairs(spark, block_turns):
    rng, convs = random.Random(7), {}
    for i in range(60):
        if convs and rng.random() < 0.7:
            base = rng.choice(list(convs.values()))
            own = base[: rng.randint(1, len(base))] + [(rng.choice("ua"), rng.choice(["x", None, ""]), 0) for _ in range(rng.randint(0, 3))]
        else:
            own = [(rng.choice("ua"), rng.choice("xyz"), 0) for _ in range(rng.randint(1, 9))]
        convs[i] = [(r, t) for r, t, *_ in own]
    rows = [(i, 2 * k + 5, r, t, 9) for i, own in convs.items() for k, (r, t) in enumerate(own)]
    rows += rows[::7]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, SCHEMA)
    got = collapse(turns, block_turns=block_turns).collect()
    assert {r.conv: r.reason for r in got} == slow_collapse(convs) and {r.conv: r.n_turns for r in got} == {i: len(c) for i, c in convs.items()}
    text = {}
    for r in sorted(format_chats(turns, block_turns=block_turns).collect()):
        text[r.conv] = text.get(r.conv, "") + r.rendered
    want = {i: "".join(f"<|{r}|>\n{t or ''}<|end|>\n" for r, t in convs[i]) for i, why in slow_collapse(convs).items() if why == "maximal"}
    assert text == want


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('/root/testdata/{folder}/conversations.parquet')")
    columns = "conv_id, segment, turns, rendered"
    want = con.execute(f"select {columns} from ({ORACLE_SQL['op9_chats']})").fetchall()
    got = [tuple(r) for r in QUERIES["op9_chats"](spark, f"/root/testdata/{folder}").select(*columns.split(", ")).collect()]
    assert sorted(got) == sorted(want)


def test_edge_rows(spark):
    rows = [(None, 0, "user", "a", 1), (1, None, None, None, 1), (1, 0, "user", "<|end|>", 1), (1, 0, "user", "<|end|>", 1), (2, 0, "user", "long " * 50000, 1), (3, 0, "user", "<|end|>", 1), (4, 0, "user", "b", 1), (4, 0, "user", "a", 1)]
    turns = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv: r.reason for r in collapse(turns).collect()}
    assert got == {1: "maximal", 2: "maximal", 3: "prefix", 4: "maximal"}
    first = [r.rendered for r in sorted(format_chats(turns).collect()) if r.conv == 1]
    assert "".join(first) == "<|user|>\n< |end|><|end|>\n<|unknown|>\n<|end|>\n"
    assert collapse(turns.limit(0)).collect() == [] == format_chats(turns.limit(0)).collect()
