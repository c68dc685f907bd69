"""Stored states and copies: built once, refreshed by new files only, compacted, measured."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillflow import registry
from tillflow.operators import table_stats
from tillflow.session import built
from tillflow.sources import views
from tillflow.sources.generator import Generator
from tillflow.streaming import pipelines
from tillflow.streaming import views as maintained


def test_built_once_and_again_after_a_failure(spark):
    calls = []

    def build(path):
        calls.append(path)
        if len(calls) == 1:
            raise OSError("no space")

    with pytest.raises(OSError):
        built(spark, "here", "test-built", build)
    first = built(spark, "here", "test-built", build)
    assert built(spark, "here", "test-built", build) == first == calls[1]
    assert built(spark, "there", "test-built", build) != first


def test_refresh_takes_new_files_only(spark, sf_dir, tmp_path):
    events, root = spark.read.parquet(f"{sf_dir}/events.parquet"), str(tmp_path / "views")
    view, folder = maintained.payment_metrics(), str(tmp_path / "in")

    def refresh():
        source = pipelines.stream_files(spark, folder, views.SCHEMAS["events"])
        pipelines.refresh(source, [view], root, f"{root}/_cp", views.as_transactions)
        stored = pipelines.stored(spark, view, root)
        count = F.sum("transaction_count")
        return stored.agg(count).first()[0], stored.select("batch_id").distinct().count()

    events.where("event_id % 2 = 0").write.parquet(folder)
    half = events.where("event_id % 2 = 0").count()
    assert refresh() == (half, 1)
    assert refresh() == (half, 1)
    events.where("event_id % 2 = 1").write.mode("append").parquet(folder)
    assert refresh() == (events.count(), 2)


def test_row_view_compacts(spark, sf_dir, tmp_path):
    root, target = str(tmp_path / "views"), str(tmp_path / "compact")
    view, txn = maintained.enriched(), views.txn(spark, sf_dir)
    for k in range(3):
        pipelines.write_delta(view, txn.where(f"transaction_id % 3 = {k}"), root, k, "s")
    pipelines.compact_view(spark, view, root, target, up_to=1)
    both = pipelines.compacted_and_new(spark, view, root, target, up_to=1).drop("ym")
    assert both.exceptAll(view.delta(txn)).isEmpty() and both.count() == txn.count()


def test_merged_states_scan_the_store(spark, sf_dir):
    plan = registry.queries()["hourly_revenue_read"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "events.parquet" not in plan and "hour" in plan.split("PushedFilters", 1)[1]


def test_a_file_with_several_partitions_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select("id", F.when(F.col("id") > 4, F.lit(1)).alias("ym"))
    rows.coalesce(1).write.parquet(path)
    with pytest.raises(Exception, match="several partitions"):
        table_stats.partition_stats(spark.read.parquet(path), "ym").collect()
    rows.write.partitionBy("ym").parquet(f"{path}2")
    stats = table_stats.partition_stats(spark.read.parquet(f"{path}2"), "ym").collect()
    assert {(r.partition, r["rows"]) for r in stats} == {(None, 5), (1, 5)}


def test_partition_bytes_add_up(spark, sf_dir):
    stats = registry.queries()["partition_stats"](spark, sf_dir)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    total = stats.agg(F.sum("rows"), F.sum("bytes_on_disk")).first()
    assert total[0] == rows and 0 < total[1] < 1000 * rows


def test_ids_of_two_loads_differ(spark):
    one, two = (Generator().rows(spark, 20).select("transaction_id") for _ in range(2))
    assert one.intersect(two).isEmpty()
    with pytest.raises(ValueError):
        Generator(seed=True)
