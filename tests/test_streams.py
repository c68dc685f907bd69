from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillflow.operators.joins import enrich
from tillflow.sources import views
from tillflow.streaming import hours, pipelines
from tillflow.streaming import views as maintained


@pytest.fixture(scope="module")
def events(spark, sf_dir, tmp_path_factory):
    """The events as five files."""
    folder = str(tmp_path_factory.mktemp("events") / "files")
    views.table(spark, sf_dir, "events").repartition(5, "event_id").write.parquet(folder)
    return folder


def stream(spark, folder, files=2):
    schema = spark.read.parquet(folder).schema
    return pipelines.stream_files(spark, folder, schema, files)


def feed(spark, folder, fed, root, prepare=views.as_transactions, files=2):
    running = pipelines.maintain(stream(spark, folder, files), fed, root, f"{root}/_cp", prepare)
    running.awaitTermination()
    return running


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_split_gives_the_batch_result(spark, sf_dir, events, tmp_path):
    view = maintained.user_spending()
    expected = rows_of(view.read(view.delta(views.txn(spark, sf_dir))))
    for files in (1, 5):
        root = str(tmp_path / f"split{files}")
        feed(spark, events, [view], root, files=files)
        stored = pipelines.stored(spark, view, root)
        assert stored.select("batch_id").distinct().count() == (5 if files == 1 else 1)
        assert rows_of(view.read(stored)) == expected


def test_only_new_files_are_read_after_a_restart(spark, sf_dir, events, tmp_path):
    view, root, inbox = maintained.daily_summary(), str(tmp_path / "out"), str(tmp_path / "inbox")
    all_events = views.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    all_events.where(early).coalesce(1).write.mode("append").parquet(inbox)
    feed(spark, inbox, [view], root)
    all_events.where(~early).coalesce(1).write.mode("append").parquet(inbox)
    feed(spark, inbox, [view], root)
    expected = view.read(view.delta(views.txn(spark, sf_dir)))
    assert rows_of(view.read(pipelines.stored(spark, view, root))) == rows_of(expected)
    # The query is stopped; what it stored stays readable.
    assert not spark.streams.active


def test_failing_view_fails_the_batch_and_a_retry_counts_once(spark, sf_dir, events, tmp_path):
    root = str(tmp_path / "failing")
    good = maintained.by_category()
    broken = maintained.RowView("broken", lambda: [(F.col("user_id") / F.lit(0)).alias("unit_price")], None)
    with pytest.raises(StreamingQueryException):
        feed(spark, events, [good, broken], root)
    # The first view had written its part of the batch already.
    assert pipelines.stored(spark, good, root).count() > 0
    fixed = maintained.RowView("broken", lambda: [F.try_divide("user_id", F.lit(0)).alias("unit_price")], None)
    feed(spark, events, [good, fixed], root)
    total = good.read(pipelines.stored(spark, good, root)).agg(F.sum("total_amount")).first()[0]
    assert total == views.txn(spark, sf_dir).agg(F.sum("amount")).first()[0]
    assert spark.read.parquet(f"{root}/broken").count() == views.txn(spark, sf_dir).count()


def test_compaction_keeps_the_meaning(spark, sf_dir, events, tmp_path):
    view, root, target = maintained.hourly_revenue(), str(tmp_path / "out"), str(tmp_path / "compacted")
    feed(spark, events, [view], root)
    before = rows_of(view.read(pipelines.stored(spark, view, root)))
    pipelines.compact_view(spark, view, root, target, up_to=1, partitions=2)
    states = pipelines.compacted_and_new(spark, view, root, target, up_to=1)
    assert rows_of(view.read(states)) == before
    pipelines.compact_view(spark, view, root, f"{target}2", up_to=2)
    assert spark.read.parquet(f"{target}2").count() <= pipelines.stored(spark, view, root).count()


def test_dimension_is_read_on_arrival(spark, sf_dir, tmp_path):
    """A later rename does not touch rows that were joined before it."""
    inbox, root, dim = (str(tmp_path / n) for n in ("inbox", "out", "dim"))
    view = maintained.RowView(
        "named", lambda: ["transaction_id", "merchant_name", "created_at"]
    )

    def names(name):
        df = spark.range(100).select(F.col("id").alias("merchant_id"), F.lit(name).alias("name"))
        df.write.mode("overwrite").parquet(dim)

    def join(batch, dimension):
        return enrich(views.as_transactions(batch), dimension, "merchant_id", {"name": "merchant_name"}, "left")

    prepare = pipelines.joined_at_arrival(lambda: spark.read.parquet(dim), join)
    half = views.table(spark, sf_dir, "events")
    for parity, name in ((0, "old"), (1, "new")):
        names(name)
        half.where(F.col("event_id") % 2 == parity).coalesce(1).write.mode("append").parquet(inbox)
        feed(spark, inbox, [view], root, prepare)
    got = pipelines.stored(spark, view, root).groupBy(
        F.col("transaction_id") % 2, "merchant_name"
    ).count().collect()
    assert {(r[0], r[1]) for r in got} == {(0, "old"), (1, "new")}


def test_repeats_are_dropped_within_and_across_batches(spark, sf_dir, events, tmp_path):
    def thinned(batch):
        txn = views.as_transactions(batch)
        return pipelines.without_repeats(txn.unionByName(txn), ["transaction_id"])

    out = str(tmp_path / "unique")
    for again in ("cp1", "cp2"):
        pipelines.write_batches(stream(spark, events, 2), thinned, out, str(tmp_path / again)).awaitTermination()
    stored, n = spark.read.parquet(out), views.txn(spark, sf_dir).count()
    assert stored.count() == 2 * n
    assert pipelines.without_repeats(stored, ["transaction_id"]).count() == n


@pytest.mark.parametrize("name", ["stream_hourly_watermark", "stream_dedup", "stream_hourly_revenue"])
def test_stream_queries_read_a_folder_in_any_order(spark, sf_dir, tmp_path, monkeypatch, name):
    """The table as a folder of files out of time order, a batch each."""
    from tillflow import registry

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(6, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    want = rows_of(registry.queries()[name](spark, sf_dir))
    whole = pipelines.stream_files
    monkeypatch.setattr(pipelines, "stream_files", lambda *a: whole(*a, files_per_batch=1))
    assert rows_of(registry.queries()[name](spark, str(tmp_path))) == want


def test_batches_are_cut_by_bytes(spark, events, tmp_path):
    size = max(f.stat().st_size for f in Path(events).glob("*.parquet"))
    source = pipelines.stream_files(spark, events, spark.read.parquet(events).schema, bytes_per_batch=2 * size)
    out = str(tmp_path / "out")
    pipelines.write_batches(source, lambda b: b, out, str(tmp_path / "cp")).awaitTermination()
    assert 2 <= spark.read.parquet(out).select("batch_id").distinct().count() <= 4


def test_backfill_and_delta_make_the_whole_view(spark, sf_dir):
    txn, view = views.txn(spark, sf_dir), maintained.category_stats()
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    parts = view.delta(txn.where(F.col("created_at") < cut)).unionByName(
        view.delta(txn.where(F.col("created_at") >= cut))
    )
    assert rows_of(view.read(parts)) == rows_of(view.read(view.delta(txn)))


def test_hours_roll_up_to_days_and_months(spark, sf_dir):
    txn, view = views.txn(spark, sf_dir), maintained.daily_merchant_summary()
    days = view.delta(txn)
    months = view.roll_up(days, [F.trunc("date", "month").alias("month")])
    total = months.agg(F.sum("revenue"), F.sum("orders")).first()
    done = txn.where("status = 'completed'").agg(F.sum("amount"), F.count("*")).first()
    assert tuple(total) == tuple(done)


def test_streams_and_backfills_share_a_view(spark, tmp_path):
    root = str(tmp_path)
    view = maintained.RowView("kept", lambda: ["n", "created_at"])
    rows = spark.sql("SELECT id AS n, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS created_at FROM range(10)")
    one, two = (pipelines.stream_id(f"{root}/{x}") for x in ("one", "two"))
    pipelines.write_delta(view, rows.where("n < 4"), root, 0, one)
    pipelines.write_delta(view, rows.where("n >= 4 AND n < 9"), root, 0, two)
    for _ in range(2):  # a repeated attempt counts once
        pipelines.write_delta(view, rows.where("n = 9"), root, 0)
    assert sorted(r.n for r in pipelines.stored(spark, view, root).collect()) == list(range(10))
    assert pipelines.stored(spark, view, root, {one: 0, "backfill": 0}).count() == 5
    with pytest.raises(ValueError):
        pipelines.stored(spark, view, root, 0)


def test_a_wiped_checkpoint_is_a_new_stream(spark, sf_dir, tmp_path):
    """A second stream at the path of the first keeps what that one stored."""
    import shutil

    view, root = maintained.by_user(), str(tmp_path / "out")
    all_events = views.table(spark, sf_dir, "events").orderBy("event_id").limit(8)
    first, second = (str(tmp_path / n) for n in ("first", "second"))
    all_events.where("event_id % 8 < 5").repartition(5, "event_id").write.parquet(first)
    all_events.where("event_id % 8 >= 5").repartition(3, "event_id").write.parquet(second)
    feed(spark, first, [view], root, files=1)
    name = pipelines.stream_id(f"{root}/_cp", spark)
    shutil.rmtree(f"{root}/_cp")
    feed(spark, second, [view], root, files=1)
    assert pipelines.stream_id(f"{root}/_cp", spark) != name
    total = pipelines.stored(spark, view, root).agg(F.sum("total_amount")).first()[0]
    assert total == views.as_transactions(all_events).agg(F.sum("amount")).first()[0]


def test_half_a_batch_does_not_count_and_a_retry_counts_once(spark, tmp_path, monkeypatch):
    from tillflow.sources import files

    root, view = str(tmp_path), maintained.RowView("kept", lambda: ["n", "created_at"])
    rows = spark.sql("SELECT id AS n, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS created_at FROM range(10)")
    pipelines.write_delta(view, rows.where("n < 4"), root, 0, "s1")

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(files, "write_text", fail)
        pipelines.write_delta(view, rows.where("n >= 4"), root, 1, "s1")
    assert pipelines.stored(spark, view, root).count() == 4
    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(files, "delete", fail)
        pipelines.write_delta(view, rows.where("n < 4"), root, 0, "s1")
    assert pipelines.stored(spark, view, root).count() == 4
    pipelines.write_delta(view, rows.where("n >= 4"), root, 1, "s1")
    assert sorted(r.n for r in pipelines.stored(spark, view, root).collect()) == list(range(10))


def _hours_of(txn):
    return rows_of(
        txn.groupBy(F.date_trunc("hour", "created_at").cast("timestamp_ntz").alias("hour")).agg(
            F.count("*").alias("transactions"), F.sum("amount").cast("decimal(38,2)").alias("revenue")
        )
    )


def test_open_hours_are_bounded_and_late_rows_kept(spark, sf_dir, events, tmp_path):
    """Files out of order, a retry of a batch and rows without a time; nothing lost or doubled."""
    target, checkpoint, inbox = (str(tmp_path / n) for n in ("out", "cp", "in"))
    late_and_none = spark.read.parquet(events).withColumn(
        "ts", F.when(F.col("event_id") % 50 != 0, F.col("ts"))
    )
    late_and_none.repartition(6, "event_id").write.parquet(inbox)

    def run():
        payments = views.as_transactions(stream(spark, inbox, 1))
        hours.maintain_hours(payments, target, checkpoint, "3 days").awaitTermination()

    run()
    want = _hours_of(views.as_transactions(late_and_none))
    assert rows_of(hours.hour_totals(spark, target)) == want
    rows = pipelines.written(spark, target)
    assert {r.part for r in hours.hour_parts(spark, target).collect()} == {"open", "closed", "late"}
    # From the third batch on the watermark is near the end: three days are open, not thirty.
    kept = rows.where("part = 'open' AND batch_id >= 2").groupBy("batch_id").count()
    assert kept.agg(F.max("count")).first()[0] <= 4 * 24
    # A batch that ran, but wasn't committed, runs again with the same watermark.
    Path(f"{checkpoint}/commits/5").unlink()
    Path(f"{checkpoint}/commits/.5.crc").unlink(missing_ok=True)
    run()
    assert rows_of(hours.hour_totals(spark, target)) == want
    # New files go on from the open hours of the last batch.
    late_and_none.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 DAYS")).coalesce(1).write.mode("append").parquet(inbox)
    run()
    assert rows_of(hours.hour_totals(spark, target)) == _hours_of(
        views.as_transactions(spark.read.parquet(inbox))
    )


def test_two_streams_of_hours_share_a_target(spark, events, tmp_path):
    target = str(tmp_path / "out")
    for name in ("one", "two"):
        payments = views.as_transactions(stream(spark, events, 2))
        hours.maintain_hours(payments, target, str(tmp_path / name)).awaitTermination()
    txn = views.as_transactions(spark.read.parquet(events))
    assert rows_of(hours.hour_totals(spark, target)) == _hours_of(txn.unionByName(txn))


def test_open_hours_that_are_gone_stop_the_stream(spark, events, tmp_path):
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    first = str(tmp_path / "in")
    spark.read.parquet(events).coalesce(1).write.parquet(first)
    hours.maintain_hours(views.as_transactions(stream(spark, first)), target, checkpoint).awaitTermination()
    spark.read.parquet(events).coalesce(1).write.mode("append").parquet(first)
    with pytest.raises(StreamingQueryException):
        gone = str(tmp_path / "elsewhere")
        hours.maintain_hours(views.as_transactions(stream(spark, first)), gone, checkpoint).awaitTermination()
