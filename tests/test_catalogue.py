import duckdb
import pytest

from inkmill.plans.catalogue import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, oracle, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if name in ORACLE_SQL:
        listed = ", ".join(f'"{c}"' for c in columns)
        assert rows == sorted(repr(r) for r in oracle.execute(f"select {listed} from ({ORACLE_SQL[name]})").fetchall())
    else:
        assert rows


def test_no_cartesian_products(spark, sf):
    plan = QUERIES["q18_iou_pairs"](spark, sf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pushdown_and_pruning(spark, sf):
    plan = QUERIES["q09_runs"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), LessThan(o_totalprice,150000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
