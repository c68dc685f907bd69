from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.operators import merges

NOON = datetime(2024, 1, 1, 10, 0)
LATER = datetime(2024, 1, 1, 10, 5)


def test_newer_name_replaces_older(spark):
    rows = [(1, "Alice", NOON), (1, "Alice Smith", LATER)]
    df = spark.createDataFrame(rows, "id int, name string, v timestamp_ntz")
    assert [r.name for r in merges.latest_version(df, ["id"], "v").collect()] == ["Alice Smith"]


def test_status_update(spark):
    rows = [("a", "99.99", "pending", 0), ("a", "99.99", "completed", 1)]
    df = spark.createDataFrame(rows, "id string, amount string, status string, v int")
    (row,) = merges.latest_version(df, ["id"], "v").collect()
    assert (row.status, row.amount) == ("completed", "99.99")


def test_last_insert_without_version(spark):
    rows = [(1, "Widget", "29.99", 100, 1), (1, "Widget Pro", "39.99", 150, 2)]
    df = spark.createDataFrame(rows, "id int, name string, price string, stock int, seq int")
    (row,) = merges.last_insert(df, ["id"], "seq").collect()
    assert (row.name, row.stock) == ("Widget Pro", 150)


def test_scope_keeps_one_row_per_partition(spark):
    df = spark.createDataFrame([(1, 1, 202401), (1, 2, 202402)], "id int, v int, ym int")
    assert merges.latest_version(df, ["id"], "v").count() == 1
    assert merges.latest_version(df, ["id"], "v", scope=["ym"]).count() == 2


def test_filter_sees_only_the_latest_rows(spark):
    df = spark.createDataFrame([(1, 1, "open"), (1, 2, "closed")], "id int, v int, s string")
    assert merges.latest_version(df, ["id"], "v").where("s = 'open'").count() == 0


def test_deleted_keys_disappear(spark):
    rows = [(1, 0, 1), (1, 1, 2), (2, 1, 1), (2, 0, 3)]
    df = spark.createDataFrame(rows, "id int, is_deleted int, v int")
    assert [r.id for r in merges.current_state(df, ["id"], "v").collect()] == [2]


def test_latest_versions_are_idempotent_and_match_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 20), rng.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int, tie int").repartition(7)
    once = merges.latest_version(df, ["k"], "v", ["tie"])
    expected = {}
    for k, v, tie in rows:
        expected[k] = max(expected.get(k, (-1, -1)), (v, tie))
    assert {r.k: (r.v, r.tie) for r in once.collect()} == expected
    twice = merges.latest_version(once, ["k"], "v", ["tie"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    picked = merges.latest_values(df, ["k"], ["v", "tie"], ["v", "tie"])
    assert {r.k: (r.v, r.tie) for r in picked.collect()} == expected


def test_hot_key_is_trimmed_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = merges.latest_version(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


@pytest.mark.parametrize(
    "rows, total",
    [([(10, "100.00"), (5, "50.00"), (3, "30.00")], (18, Decimal("180.00"))),
     ([(5, "100.00"), (10, "200.00")], (15, Decimal("300.00")))],
)
def test_summing(spark, rows, total):
    df = spark.createDataFrame([(5001, n, a) for n, a in rows], "m int, n long, a string")
    df = df.withColumn("a", F.col("a").cast("decimal(18,2)"))
    (row,) = merges.summing(df, ["m"]).collect()
    assert (row.n, row.a) == total
    (again,) = merges.summing(merges.summing(df, ["m"]), ["m"]).collect()
    assert (again.n, again.a) == total


def test_collapsing(spark):
    rows = [(1, 100, 1), (1, 100, -1), (1, 150, 1)]
    df = spark.createDataFrame(rows, "user_id int, balance int, sign int")
    assert [tuple(r) for r in merges.collapse(df).collect()] == [(1, 150, 1)]


def test_versioned_collapsing_in_any_order(spark):
    rows = [(1, 100, 1, 1), (1, 200, 1, 3), (1, 100, -1, 1), (1, 150, 1, 2), (1, 150, -1, 2)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "user_id int, balance int, sign int, version int")
        out = merges.collapse(df).select("user_id", "balance", "version", "sign").collect()
        assert [tuple(r) for r in out] == [(1, 200, 3, 1)]


def test_cancel_without_its_row_is_reported(spark):
    df = spark.createDataFrame([(1, 5, -1), (1, 5, -1), (2, 6, 1)], "k int, b int, sign int")
    assert [tuple(r) for r in merges.unmatched_cancels(df).collect()] == [(1, 5, 2)]
    assert [r.k for r in merges.collapse(df).collect()] == [2]


def test_rows_left_over_several_times_stay(spark):
    rows = [(1, 100, 1), (1, 100, 1), (1, 100, 1), (1, 100, -1), (2, 5, 1)]
    df = spark.createDataFrame(rows, "user_id int, balance int, sign int")
    out = sorted(tuple(r) for r in merges.collapse(df).collect())
    assert out == [(1, 100, 1), (1, 100, 1), (2, 5, 1)]


def test_many_copies_of_a_row_are_made_in_blocks(spark):
    df = spark.createDataFrame([(1, 10_001), (2, 4096), (3, -5), (4, 1)], "k int, sign long")
    got = {r.k: r["count"] for r in merges.collapse(df).groupBy("k").count().collect()}
    assert got == {1: 10_001, 2: 4096, 4: 1}
