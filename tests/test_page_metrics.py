"""q51 on tables whose rows are out of order, hold nulls, or have values that round at a half."""

import random

import duckdb
import pytest

from inkmill.plans.catalogue import ORACLE_SQL, QUERIES


def check(spark, folder, rows):
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").repartition(3).write.parquet(f"{folder}/events.parquet")
    con = duckdb.connect()
    con.execute("set threads = 1")
    con.execute(f"create view events as select * from (select * from '{folder}/events.parquet/*.parquet' order by event_id)")
    want = con.execute(f"select page, detections, empty_groups, sure from ({ORACLE_SQL['q51_page_metrics']})").fetchall()
    got = QUERIES["q51_page_metrics"](spark, str(folder)).select("page", "detections", "empty_groups", "sure").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    return want


def test_means_of_just_fifty_are_summed_in_the_order_of_events(spark, tmp_path):
    rng, rows = random.Random(1), []
    for page in range(60):  # each sum is 1,000.00 in decimals, and may be a little more or less in doubles
        cents = [rng.randrange(10_000) for _ in range(10)]
        rows += [(page, c / 100) for c in cents] + [(page, (10_000 - c) / 100) for c in cents]
    rng.shuffle(rows)
    want = check(spark, tmp_path, [(k, page, "click", value) for k, (page, value) in enumerate(rows)])
    assert {r[3] for r in want} == {True, False}


@pytest.mark.parametrize("value", [None, float("nan"), 50.005, 50.004999])
def test_nulls_and_halves(spark, tmp_path, value):
    check(spark, tmp_path, [(1, 7, "error", value), (2, 7, "click", 50.0), (3, 8, "error", value), (4, 9, "error", 60.0), (5, 9, None, None), (6, None, "click", 1.005)])
