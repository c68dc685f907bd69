from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillflow.sources.generator import Generator, size_estimate
from tillflow.sources.schemas import (
    CATEGORY_AMOUNTS, CURRENCIES, PAYMENT_METHODS, STATUS_WEIGHTS,
)

END = datetime(2024, 1, 31)


@pytest.mark.parametrize("argument", ["users", "merchants", "days"])
def test_arguments_are_checked(argument):
    with pytest.raises(ValueError, match=argument):
        Generator(**{argument: 0})


def test_seed_must_be_an_integer():
    with pytest.raises(ValueError, match="seed"):
        Generator(seed="x")


def test_sizes_are_checked(spark):
    g = Generator(10, 5, 7, 42)
    with pytest.raises(ValueError, match="size"):
        g.rows(spark, 0)
    with pytest.raises(ValueError, match="user_id"):
        g.for_user(spark, 0)
    with pytest.raises(ValueError, match="batch_size"):
        g.batches(spark, 10, 0)


def test_batch_of_fifty(spark):
    assert Generator(10, 5, 7, 42).rows(spark, 50).count() == 50


def test_batches_add_up(spark):
    counts = Generator(10, 5, 7).batches(spark, 250, 100).groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in counts} == {0: 100, 1: 100, 2: 50}


def test_same_seed_same_rows_whatever_the_tasks(spark):
    a = Generator(seed=99, as_of=END).rows(spark, 500, tasks=1)
    b = Generator(seed=99, as_of=END).rows(spark, 500, tasks=7)
    other = Generator(seed=98, as_of=END).rows(spark, 500)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    ids = [[r.user_id for r in g.orderBy("transaction_id").collect()] for g in (a, other)]
    assert ids[0] != ids[1]


def test_pinned_pools(spark):
    g = Generator(10, 5, 7, 1)
    assert [r.user_id for r in g.for_user(spark, 42, 20).collect()] == [42] * 20
    assert [r.merchant_id for r in g.for_merchant(spark, 7, 20).collect()] == [7] * 20


def test_values_stay_in_their_domains(spark):
    n = 20_000
    rows = Generator(users=100, merchants=20, days=30, seed=5, as_of=END).rows(spark, n).cache()
    s = rows.agg(
        F.min("user_id"), F.max("user_id"), F.min("merchant_id"), F.max("merchant_id"),
        F.min("created_at"), F.max("created_at"), F.count_distinct("transaction_id"),
    ).first()
    assert tuple(s)[:4] == (1, 100, 1, 20)
    assert s[4] >= END - timedelta(days=30) and s[5] <= END and s[6] == n
    shares = {r.status: r["count"] / n for r in rows.groupBy("status").count().collect()}
    assert set(shares) == set(STATUS_WEIGHTS)
    for status, weight in STATUS_WEIGHTS.items():
        assert abs(shares[status] - weight / 100) < 0.01
    assert {r.currency for r in rows.select("currency").distinct().collect()} == set(CURRENCIES)
    methods = rows.select("payment_method").distinct().collect()
    assert {r.payment_method for r in methods} == set(PAYMENT_METHODS)
    for r in rows.groupBy("category").agg(F.min("amount"), F.max("amount")).collect():
        low, high = CATEGORY_AMOUNTS[r.category]
        assert low <= r[1] and r[2] <= high
    done = F.col("status").isin("completed", "failed", "refunded")
    assert rows.where(done != F.col("processed_at").isNotNull()).count() == 0
    delay = F.timestamp_diff("SECOND", F.col("created_at"), F.col("processed_at"))
    d = rows.agg(F.min(delay), F.max(delay)).first()
    assert tuple(d) == (1, 60)
    rows.unpersist()


def test_size_estimate(spark):
    df = spark.createDataFrame([(0,), (1000,)], "row_count long")
    none, some = size_estimate(df).orderBy("row_count").collect()
    assert none.estimated_uncompressed_bytes == 0 and none.estimated_compressed_mb_high == 0
    assert some.estimated_uncompressed_bytes == 120_000
    assert some.estimated_compressed_bytes_low < some.estimated_compressed_bytes_high
    assert some.estimated_uncompressed_mb == 0.11
