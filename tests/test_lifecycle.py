from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillflow.operators import layouts, lifecycle, table_stats
from tillflow.sources import tables, views

AS_OF = datetime(2024, 6, 15)


def stamped(spark, moments):
    rows = [(i, t) for i, t in enumerate(moments)]
    return spark.createDataFrame(rows, "id int, ts timestamp_ntz")


def test_rows_expire_at_the_limit(spark):
    df = stamped(spark, [AS_OF - timedelta(days=30), AS_OF - timedelta(days=30) + timedelta(seconds=1)])
    assert [r.id for r in lifecycle.expire_rows(df, "ts", AS_OF, days=30).collect()] == [1]


def test_years_follow_the_calendar(spark):
    df = stamped(spark, [datetime(2024, 2, 29), datetime(2024, 3, 1)])
    kept = lifecycle.expire_rows(df, "ts", datetime(2025, 2, 28), years=1)
    assert [r.id for r in kept.collect()] == [1]


def test_day_limit_reaches_the_scan(spark, sf_dir):
    df = lifecycle.expire_rows(views.txn(spark, sf_dir), "created_at", datetime(2024, 1, 31), days=7)
    assert "GreaterThan(ts,2024-01-24" in df._jdf.queryExecution().executedPlan().toString()


def test_ages_must_be_positive(spark):
    with pytest.raises(ValueError, match="days"):
        lifecycle.expired("ts", AS_OF, days=0)


def test_columns_expire_on_their_own(spark):
    df = stamped(spark, [AS_OF - timedelta(days=d) for d in (10, 250, 500)])
    df = df.withColumns({"email": F.lit("e"), "phone": F.lit("p"), "name": F.lit("n")})
    ages = {"email": {"years": 1}, "phone": {"months": 6}}
    got = lifecycle.expire_columns(df, "ts", ages, AS_OF).orderBy("id").collect()
    assert [(r.email, r.phone, r.name) for r in got] == [("e", "p", "n"), ("e", None, "n"), (None, None, "n")]


def test_roll_up_keeps_totals(spark, sf_dir):
    df = views.metrics(spark, sf_dir)
    rolled = lifecycle.roll_up(df, ["metric_name"], "timestamp", ["value", "count"], datetime(2024, 1, 31))
    assert rolled.count() < df.count()
    a, b = (x.agg(F.round(F.sum("value"), 4), F.sum("count")).first() for x in (df, rolled))
    assert tuple(a) == tuple(b)
    again = lifecycle.roll_up(rolled, ["metric_name"], "timestamp", ["value", "count"], datetime(2024, 1, 31))
    assert again.count() == rolled.count()


def test_tiers(spark):
    df = stamped(spark, [AS_OF - timedelta(days=d) for d in (1, 30, 89, 90, 365)])
    got = [r[0] for r in df.orderBy("id").select(lifecycle.tier("ts", AS_OF)).collect()]
    assert got == ["hot", "warm", "warm", "cold", "expired"]
    with pytest.raises(ValueError, match="names"):
        lifecycle.tier("ts", AS_OF, names=("a", "b"))


@pytest.fixture
def logs(spark, table):
    moments = [datetime(2024, m, d) for m in range(1, 7) for d in (1, 10, 14)]
    df = stamped(spark, moments).withColumn("ym", tables.monthly("ts"))
    tables.append(df, table, ["ym"])
    return table


def months(spark, name):
    return {r.ym: r["count"] for r in spark.table(name).groupBy("ym").count().collect()}


def test_expired_months_are_dropped_and_the_limit_month_rewritten(spark, logs):
    # 46 days before June 15 is April 30; 36 days is May 10.
    assert lifecycle.drop_expired(spark, logs, "ts", 46, AS_OF) == [202401, 202402, 202403]
    # April had become empty by then and is dropped as a whole.
    assert lifecycle.drop_expired(spark, logs, "ts", 36, AS_OF) == [202404]
    assert months(spark, logs) == {202405: 1, 202406: 3}


def test_old_months_move_to_another_table(spark, logs):
    cold = f"{logs}_cold"
    moved = lifecycle.move_old_months(spark, logs, cold, 90, AS_OF)
    assert moved == [202401, 202402]
    assert months(spark, cold) == {202401: 3, 202402: 3}
    assert set(months(spark, logs)) == {202403, 202404, 202405, 202406}
    assert lifecycle.move_old_months(spark, logs, cold, 90, AS_OF) == []


def test_recompression_shrinks_and_keeps_rows(spark, sf_dir, tmp_path):
    line = views.table(spark, sf_dir, "lineitem")
    plain, dense = str(tmp_path / "plain"), str(tmp_path / "dense")
    line.coalesce(1).write.option("compression", "uncompressed").parquet(plain)
    lifecycle.recompress(line, dense, ["l_shipdate"], 9, 1)
    size = {
        p: table_stats.table_size(spark, p, "t").first() for p in (plain, dense)
    }
    assert size[dense].bytes_on_disk < size[plain].bytes_on_disk
    assert size[dense].total_rows == size[plain].total_rows == line.count()


def test_layouts_skip_by_their_own_order(spark, sf_dir, tmp_path):
    txn = views.txn(spark, sf_dir)
    path = str(tmp_path / "by_merchant")
    for _ in range(2):
        layouts.materialize(layouts.BY_MERCHANT, txn, path, partitions=4)
    copy = layouts.load(spark, path)
    assert copy.count() == txn.count()
    ranges = copy.groupBy(F.col("_metadata.file_path")).agg(F.min("merchant_id"), F.max("merchant_id")).collect()
    ordered = sorted((r[1], r[2]) for r in ranges)
    assert len(ordered) == 4
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))


def test_grouped_layout_answers_like_the_rows(spark, sf_dir, tmp_path):
    txn, layout = views.txn(spark, sf_dir), layouts.daily_merchant()
    path = str(tmp_path / "daily")
    layouts.materialize(layout, txn, path)
    total = layout.read(layouts.load(spark, path)).agg(F.sum("txn_count"), F.sum("total_amount")).first()
    assert tuple(total) == tuple(txn.agg(F.count("*"), F.sum("amount")).first())


def test_layout_table_is_refreshed_and_dropped(spark, sf_dir, table):
    txn, layout = views.txn(spark, sf_dir), layouts.hourly_status()
    for _ in range(2):
        layouts.materialize_table(layout, txn, table)
    total = layout.read(spark.table(table)).agg(F.sum("txn_count")).first()[0]
    assert total == txn.count()
    tables.drop_table(spark, table)
    assert not tables.table_exists(spark, table)


def test_statistics_add_up(spark, sf_dir, tmp_path):
    orders = views.table(spark, sf_dir, "orders").withColumn("ym", tables.monthly("o_orderdate"))
    path = str(tmp_path / "orders")
    orders.repartition(3).write.partitionBy("ym").parquet(path)
    stored = spark.read.parquet(path)
    stats = table_stats.partition_stats(stored, "ym").collect()
    assert sum(r.rows for r in stats) == orders.count()
    whole = table_stats.table_size(spark, path, "orders").first()
    assert sum(r.files for r in stats) == whole.files
    assert sum(r.bytes_on_disk for r in stats) == whole.bytes_on_disk
    crowded = table_stats.many_files(stored, "ym", 2).collect()
    assert {r.partition for r in crowded} == {r.partition for r in stats if r.files > 2}
    columns = {r.column for r in table_stats.column_sizes(spark, path).collect()}
    assert columns == set(orders.columns) - {"ym"}


def test_rows_without_a_time_stay(spark):
    from datetime import datetime

    rows = [("a", datetime(2020, 1, 1), 1), ("a", None, 2), ("a", datetime(2024, 1, 30), 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, n int")
    at = datetime(2024, 1, 31)
    kept = lifecycle.expire_rows(df, "ts", at, years=2).collect()
    assert sorted(r.n for r in kept) == [2, 4]
    rolled = lifecycle.roll_up(df, ["k"], "ts", ["n"], at).collect()
    assert sorted(r.n for r in rolled) == [1, 2, 4]
