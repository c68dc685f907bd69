from __future__ import annotations

import os
from datetime import datetime, timedelta
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillflow.operators import merges
from tillflow.sources import schemas, tables
from tillflow.sources.generator import Generator

T0 = datetime(2024, 1, 15, 12)
COLUMNS = ["transaction_id", "user_id", "merchant_id", "amount", "category", "created_at"]


def monthly_schema(schema):
    from pyspark.sql.types import IntegerType, StructField, StructType

    return StructType([*schema.fields, StructField("ym", IntegerType())])


@pytest.fixture
def transactions(spark, table):
    tables.create_table(spark, table, monthly_schema(schemas.TRANSACTIONS), ["ym"])
    return table


def insert(spark, table, rows, columns=COLUMNS):
    return tables.insert_batch(
        spark, table, rows, columns, schemas.TRANSACTIONS,
        schemas.TRANSACTION_DEFAULTS, month_of="created_at",
    )


def row(i, at=T0, amount="9.99"):
    return (f"t{i}", 42, 7, Decimal(amount), "retail", at)


def test_create_is_idempotent(spark, transactions):
    tables.create_table(spark, transactions, monthly_schema(schemas.TRANSACTIONS), ["ym"])
    assert tables.table_exists(spark, transactions)
    assert tables.row_count(spark, transactions) == 0
    tables.drop_table(spark, transactions)
    tables.drop_table(spark, transactions)
    assert not tables.table_exists(spark, transactions)


def test_empty_batches_write_nothing(spark, transactions):
    assert insert(spark, transactions, []) == 0
    empty = pd.DataFrame({"user_id": []})
    assert tables.insert_pandas(spark, transactions, empty, schemas.TRANSACTIONS) == 0


def test_insert_fills_defaults_and_counts(spark, transactions):
    assert insert(spark, transactions, [row(1), row(2)]) == 2
    got = spark.table(transactions).orderBy("transaction_id").first()
    assert (got.user_id, got.merchant_id, got.amount) == (42, 7, Decimal("9.99"))
    assert (got.currency, got.status, got.payment_method) == ("USD", "pending", "card")
    assert got.processed_at is None and got.metadata == {} and got.ym == 202401


def test_generated_id_when_left_out(spark, transactions):
    assert insert(spark, transactions, [r[1:] for r in (row(1), row(2))], COLUMNS[1:]) == 2
    ids = [r.transaction_id for r in spark.table(transactions).collect()]
    assert len(set(ids)) == 2 and all(len(i) == 36 for i in ids)


def test_column_without_value_or_default_is_refused(spark, transactions):
    with pytest.raises(ValueError, match="user_id"):
        insert(spark, transactions, [("t1", T0)], ["transaction_id", "created_at"])


def test_insert_pandas(spark, transactions):
    frame = pd.DataFrame(
        {"transaction_id": ["p1"], "user_id": [1], "merchant_id": [2],
         "amount": [Decimal("5.50")], "category": ["travel"], "created_at": [T0]}
    )
    n = tables.insert_pandas(
        spark, transactions, frame, schemas.TRANSACTIONS, schemas.TRANSACTION_DEFAULTS, "created_at"
    )
    assert n == 1 and spark.table(transactions).first().amount == Decimal("5.50")


def test_insert_select_matches_names(spark, table):
    tables.create_table(spark, table, schemas.DAILY_SUMS)
    source = spark.sql(
        "SELECT cast(3 as bigint) transaction_count, cast(1.50 as decimal(18,2)) total_amount, "
        "cast(5001 as bigint) merchant_id, date'2024-01-01' metric_date"
    )
    tables.insert_select(source, table)
    got = spark.table(table).first()
    assert (got.merchant_id, got.total_amount, got.transaction_count) == (5001, Decimal("1.50"), 3)
    tables.truncate_table(spark, table)
    assert tables.row_count(spark, table) == 0


def test_load_is_partitioned_sorted_and_pruned(spark, transactions):
    made = Generator(users=50, merchants=5, days=90, seed=1, as_of=datetime(2024, 3, 31)).rows(spark, 2000)
    full = tables.with_defaults(made, schemas.TRANSACTIONS, schemas.TRANSACTION_DEFAULTS)
    assert tables.load_transactions(full, transactions, partitions=6) == 2000
    stored = spark.table(transactions)
    assert {r.ym for r in stored.select("ym").distinct().collect()} <= {202401, 202402, 202403, 202312}
    by_file = stored.select(
        "user_id", "created_at", F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("i")
    ).collect()
    for f in {r.f for r in by_file}:
        keys = [(r.user_id, r.created_at) for r in sorted((r for r in by_file if r.f == f), key=lambda r: r.i)]
        assert keys == sorted(keys)

    from tillflow.clock import last_days

    recent = last_days(stored, 20, datetime(2024, 3, 31))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "ym" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(created_at" in plan
    expected = full.where("created_at >= '2024-03-11'").count()
    assert recent.count() == expected


def months(spark, table):
    counted = spark.table(table).groupBy("ym").count().collect()
    return {r.ym: r["count"] for r in counted}


def test_partition_lifecycle(spark, transactions):
    rows = [row(i, T0 + timedelta(days=31 * (i % 3))) for i in range(9)]
    insert(spark, transactions, rows)
    assert months(spark, transactions) == {202401: 3, 202402: 3, 202403: 3}
    tables.detach_partition(spark, transactions, {"ym": 202402})
    assert months(spark, transactions) == {202401: 3, 202403: 3}
    tables.attach_partition(spark, transactions, {"ym": 202402})
    assert months(spark, transactions)[202402] == 3
    assert tables.row_count(spark, f"{transactions}_detached") == 0
    archive = f"{transactions}_archive"
    tables.move_partition(spark, transactions, archive, {"ym": 202401})
    assert months(spark, transactions) == {202402: 3, 202403: 3}
    assert months(spark, archive) == {202401: 3}
    tables.drop_partition(spark, transactions, {"ym": 202403})
    tables.drop_partition(spark, transactions, {"ym": 202403})
    assert months(spark, transactions) == {202402: 3}


def test_compaction_merges_one_partition_only(spark, table):
    tables.create_table(spark, table, monthly_schema(schemas.TRANSACTION_VERSIONS), ["ym"])
    for version in range(3):
        at = T0 + timedelta(seconds=version)
        rows = [
            ("a", 1, 2, Decimal("99.99"), "USD", ["pending", "processing", "completed"][version],
             "retail", created, at)
            for created in (T0, T0 + timedelta(days=31))
        ]
        df = spark.createDataFrame(rows, schemas.TRANSACTION_VERSIONS)
        tables.append(df.withColumn("ym", tables.monthly("created_at")), table, ["ym"])
    assert months(spark, table) == {202401: 3, 202402: 3}

    def newest(rows):
        return merges.latest_version(rows, ["transaction_id"], "updated_at")

    for _ in range(2):
        tables.compact(spark, table, {"ym": 202401}, newest, ["ym", "transaction_id"], 1)
        assert months(spark, table) == {202401: 1, 202402: 3}
    assert spark.table(table).where("ym = 202401").first().status == "completed"


def test_partition_key_functions(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 5),)], "t timestamp_ntz")
    got = df.select(tables.monthly("t"), tables.daily("t"), tables.weekly("t")).first()
    assert (got.ym, got.ymd, str(got.week)) == (202402, 20240229, "2024-02-26")


def test_hot_month_is_split_over_tasks(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 202402).otherwise(202401).alias("ym"), F.col("id").alias("user_id")
    )
    split = tables.clustered(df, ["ym", "user_id"], 8)
    sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000 / 4


def test_shared_folder_is_below_the_session_setting(spark):
    from tillflow.session import shared_dir

    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    made = shared_dir(spark, "x")
    assert made != shared_dir(spark, "x")
    if root:
        assert made.startswith(root.rstrip("/") + os.sep)


def test_every_table_can_be_created_twice_and_loaded(spark):
    from tillflow.sources import catalog

    database = "till_tests"
    for _ in range(2):
        names = catalog.create_all(spark, database)
    assert len(names) == len(catalog.TABLES)
    for name, spec in catalog.TABLES.items():
        stored = [f.name for f in spark.table(f"{database}.{name}").schema.fields]
        assert stored == [f.name for f in spec.stored_schema.fields]
    made = Generator(users=5, merchants=5, days=40, as_of=datetime(2024, 2, 10)).rows(spark, 100)
    assert catalog.load(made, "transactions", database) == 100
    logs = spark.createDataFrame(
        [(T0, "INFO", "x"), (T0 + timedelta(days=1), "WARN", "y")],
        "timestamp timestamp_ntz, level string, message string",
    )
    assert catalog.load(logs, "logs_daily", database) == 2
    days = {r.ymd for r in spark.table(f"{database}.logs_daily").collect()}
    assert days == {20240115, 20240116}
    prices = spark.createDataFrame(
        [(1, "Widget", Decimal("29.99"), 100)], "product_id long, name string, price decimal(10,2), stock_quantity long"
    )
    assert catalog.load(prices, "products", database) == 1
    assert spark.table(f"{database}.products").first().updated_at is not None


def test_moves_add_to_what_is_there(spark, transactions):
    month = {"ym": 202401}
    insert(spark, transactions, [row(1, T0), row(2, T0)])
    tables.detach_partition(spark, transactions, month)
    insert(spark, transactions, [row(3, T0)])
    tables.attach_partition(spark, transactions, month)
    assert months(spark, transactions) == {202401: 3}
    archive = f"{transactions}_archive"
    tables.move_partition(spark, transactions, archive, month)
    insert(spark, transactions, [row(4, T0)])
    tables.move_partition(spark, transactions, archive, month)
    assert months(spark, archive) == {202401: 4} and months(spark, transactions) == {}


class Broken(OSError):
    pass


def break_at(monkeypatch, name, nth):
    """Make the nth call of a file operation fail before it does anything."""
    from tillflow.sources import files

    true, calls = getattr(files, name), []

    def call(*args, **more):
        calls.append(args)
        if len(calls) == nth:
            raise Broken(name)
        return true(*args, **more)

    monkeypatch.setattr(files, name, call)


def ids(spark, table):
    return sorted(r.transaction_id for r in spark.table(table).collect())


@pytest.mark.parametrize("step, nth", [("write_text", 1), ("move", 1), ("move", 2), ("move", 3), ("write_text", 2)])
def test_a_broken_move_loses_and_doubles_nothing(spark, transactions, monkeypatch, step, nth):
    month, archive = {"ym": 202401}, f"{transactions}_archive"
    insert(spark, transactions, [row(0)])
    tables.move_partition(spark, transactions, archive, month)
    for i in (1, 2, 3):
        insert(spark, transactions, [row(i)])
    with monkeypatch.context() as patch, pytest.raises(Broken):
        break_at(patch, step, nth)
        tables.move_partition(spark, transactions, archive, month)
    for name in (transactions, archive):
        spark.catalog.refreshTable(name)
    assert sorted(ids(spark, transactions) + ids(spark, archive)) == ["t0", "t1", "t2", "t3"]
    insert(spark, transactions, [row(20)])
    insert(spark, archive, [row(10)])
    tables.move_partition(spark, transactions, archive, month)
    assert ids(spark, archive) == ["t0", "t1", "t10", "t2", "t20", "t3"] and ids(spark, transactions) == []
    tables.move_partition(spark, archive, transactions, month)
    assert ids(spark, transactions) == ["t0", "t1", "t10", "t2", "t20", "t3"] and ids(spark, archive) == []
    assert tables.resume_moves(spark, archive) == []


def test_broken_moves_can_be_resumed_alone_and_are_listed(spark, transactions, monkeypatch):
    from tillflow.sources import ledgers

    month, archive = {"ym": 202401}, f"{transactions}_archive"
    for i in (1, 2):
        insert(spark, transactions, [row(i)])
    with monkeypatch.context() as patch, pytest.raises(Broken):
        break_at(patch, "move", 2)
        tables.move_partition(spark, transactions, archive, month)
    insert(spark, transactions, [row(3)])
    (broken,) = tables.resume_moves(spark, archive)
    assert ids(spark, archive) == ["t1", "t2"]
    spark.catalog.refreshTable(transactions)
    assert ids(spark, transactions) == ["t3"]
    rows = ledgers.history(spark, tables.moves_of(spark, archive)).collect()
    assert {r.move_id for r in rows} == {broken} and len(rows) == 2 and all(r.done for r in rows)


def test_moves_between_different_tables_are_refused(spark, transactions):
    other = f"{transactions}_other"
    tables.create_table(spark, other, monthly_schema(schemas.DAILY_SUMS), ["ym"])
    with pytest.raises(ValueError, match="columns"):
        tables.move_partition(spark, transactions, other, {"ym": 202401})


def same(rows):
    return rows


def test_rows_appended_while_a_partition_is_compacted_stay(spark, transactions):
    month = {"ym": 202401}
    for i in range(3):
        insert(spark, transactions, [row(i)])

    def late(rows):
        insert(spark, transactions, [row(7)])
        return rows

    tables.compact(spark, transactions, month, late, ["ym", "user_id"], 1)
    assert ids(spark, transactions) == ["t0", "t1", "t2", "t7"]
    assert len(tables.partition_files(spark, transactions, month)) == 2


@pytest.mark.parametrize("step, nth", [
    ("write_text", 1), ("move", 1), ("move", 2), ("move", 3), ("move", 4), ("delete", 1),
])
def test_a_broken_compaction_is_finished_by_the_next(spark, transactions, monkeypatch, step, nth):
    month = {"ym": 202401}
    for i in range(3):
        insert(spark, transactions, [row(i)])
    with monkeypatch.context() as patch, pytest.raises(Broken):
        break_at(patch, step, nth)
        tables.compact(spark, transactions, month, same, ["ym", "user_id"], 1)
    insert(spark, transactions, [row(7)])
    tables.compact(spark, transactions, month, same, ["ym", "user_id"], 1)
    assert ids(spark, transactions) == ["t0", "t1", "t2", "t7"]
    assert len(tables.partition_files(spark, transactions, month)) == 1


def test_of_two_compactions_one_fails(spark, transactions, monkeypatch):
    from tillflow.sources import ledgers

    month, true = {"ym": 202401}, ledgers.exchange
    for i in range(3):
        insert(spark, transactions, [row(i)])

    def overtaken(*args):
        monkeypatch.setattr(ledgers, "exchange", true)
        tables.compact(spark, transactions, month, same, ["ym", "user_id"], 1)
        true(*args)

    monkeypatch.setattr(ledgers, "exchange", overtaken)
    with pytest.raises(ledgers.ChangedMeanwhile):
        tables.compact(spark, transactions, month, same, ["ym", "user_id"], 1)
    spark.catalog.refreshTable(transactions)
    assert ids(spark, transactions) == ["t0", "t1", "t2"]
    tables.compact(spark, transactions, {"ym": 199901}, same, ["ym"], 1)
    assert ids(spark, transactions) == ["t0", "t1", "t2"]


def test_files_follow_bytes_not_the_session(spark, tmp_path):
    def written(rows):
        source, target = f"{tmp_path}/s{rows}", f"{tmp_path}/t{rows}"
        spark.range(rows).select("id", (F.rand(1) * 1e9).alias("x")).write.parquet(source)
        tables.clustered(spark.read.parquet(source), ["x"], file_bytes=60_000).write.parquet(target)
        return len(spark.read.parquet(target).inputFiles())

    small, large = written(50_000), written(500_000)
    assert 8 <= small <= 16 and 9 * small <= large <= 11 * small
    unknown = spark.createDataFrame([(k,) for k in range(50)], "x int")
    assert tables.planned_bytes(unknown) is None
    assert tables.clustered(unknown, ["x"]).count() == 50


def test_dense_files_do_not_make_large_tasks(spark, tmp_path):
    def sizes(rows):
        source = f"{tmp_path}/dense{rows}"
        dense = spark.range(rows).select((F.col("id") % 7).alias("k"), F.expr("id div 100").cast("string").alias("s"))
        dense.coalesce(1).write.parquet(source)
        read = spark.read.parquet(source)
        assert tables.planned_bytes(read) < rows * 28 / 4
        split = tables.clustered(read, ["s", "k"], file_bytes=1 << 20)
        return [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]

    small, large = sizes(200_000), sizes(800_000)
    assert sum(small) == 200_000 and sum(large) == 800_000
    assert len(small) == 6 and len(large) == 22
    assert max(small + large) < 2 * (1 << 20) / 28
    empty = spark.read.parquet(f"{tmp_path}/dense200000").where("k > 7")
    assert tables.clustered(empty, ["k"]).count() == 0


def test_a_table_of_two_keys_is_loaded_pruned_expired_and_moved(spark, table):
    from tillflow.operators import lifecycle
    from tillflow.sources import catalog

    database, spec = "till_tests", catalog.TABLES["transactions_by_category"]
    name = catalog.create(spark, "transactions_by_category", database)
    tables.truncate_table(spark, name)
    made = Generator(users=20, merchants=5, days=150, seed=3, as_of=datetime(2024, 6, 10)).rows(spark, 600)
    odd = made.limit(1).withColumn("category", F.lit("it's 50% a/b=c"))
    both = made.unionByName(odd)
    assert catalog.load(both, "transactions_by_category", database, 3) == 601
    stored = spark.table(name)
    assert stored.columns[-2:] == ["ym", "category"] and stored.count() == 601

    recent = spec.between(stored, "created_at", datetime(2024, 4, 20), datetime(2024, 5, 3))
    plan = recent.where("category = 'travel'")._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert "ym" in pruned and "category" in pruned
    expected = both.where("created_at BETWEEN '2024-04-20' AND '2024-05-03'")
    assert recent.count() == expected.count() > 0

    archive = f"{table}_archive"
    one = tables.partitions_of(spark, name, {"ym": 202403})
    assert len(one) > 3 and all(p["ym"] == 202403 and p["category"] for p in one)
    march = stored.where("ym = 202403").count()
    tables.move_partition(spark, name, archive, {"ym": 202403})
    assert spark.table(archive).count() == march and spark.table(name).where("ym = 202403").count() == 0
    strange = odd.first()
    key = {"ym": strange.created_at.year * 100 + strange.created_at.month, "category": "it's 50% a/b=c"}
    tables.move_partition(spark, name, archive, key)
    assert spark.table(archive).where(F.col("category") == key["category"]).count() == 1
    tables.compact(spark, name, {"ym": 202404}, same, ["user_id"], 1)
    assert {len(tables.partition_files(spark, name, p)) for p in tables.partitions_of(spark, name, {"ym": 202404})} <= {0, 1}
    left = lifecycle.drop_expired(spark, name, "created_at", 40, datetime(2024, 6, 10))
    assert 202404 in left and 202405 not in left
    kept = both.where("created_at > '2024-05-01' AND category <> \"it's 50% a/b=c\"").count()
    assert spark.table(name).count() == kept
    assert lifecycle.move_old_months(spark, name, archive, 5, datetime(2024, 6, 10)) == [202405]


def test_weekly_keys_imply_their_bounds(spark):
    from tillflow.sources import catalog

    spec = catalog.TABLES["payments_weekly"]
    name = catalog.create(spark, "payments_weekly", "till_tests")
    tables.truncate_table(spark, name)
    made = Generator(users=9, merchants=5, days=60, seed=4, as_of=datetime(2024, 6, 10)).rows(spark, 300)
    catalog.load(made, "payments_weekly", "till_tests", 2)
    low, high = datetime(2024, 5, 8, 5), datetime(2024, 5, 20, 7)
    some = spec.between(spark.table(name), "created_at", low, high)
    assert some.count() == made.where(F.col("created_at").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))).count() > 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "week" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    weeks = {p["week"] for p in tables.partitions_of(spark, name)}
    assert all(w.weekday() == 0 for w in weeks)
