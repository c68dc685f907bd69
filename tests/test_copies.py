"""Stored copies follow their source, in the same session, by new files alone."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillflow import registry
from tillflow.sources import copies, files, views


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def growing(spark, sf_dir, tmp_path):
    """A folder of events of which only half is there yet, and a function that adds the rest."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = f"{tmp_path}/d"

    def add(part):
        events.where(F.col("event_id") % 2 == part).repartition(2, "event_id").write.mode("append").parquet(f"{folder}/events.parquet")

    add(0)
    return folder, add


@pytest.mark.parametrize("name", [
    "layout_daily_merchant", "layout_by_merchant", "merchant_recent100", "state_merge_merchant",
    "hourly_revenue_read", "mv_chain_monthly", "aggregating_final",
])
def test_queries_follow_new_files(spark, sf_dir, growing, name):
    folder, add = growing
    query = registry.queries()[name]
    half = rows_of(query(spark, folder))
    add(1)
    assert rows_of(query(spark, folder)) == rows_of(query(spark, sf_dir)) != half


def test_only_new_files_are_read_and_lost_ones_start_anew(spark, growing, tmp_path):
    folder, add = growing
    source, root, seen = f"{folder}/events.parquet", f"{tmp_path}/copy", []

    def make(paths, target):
        seen.append(len(paths))
        spark.read.schema(views.SCHEMAS["events"]).parquet(*paths).select("event_id").write.parquet(target)

    def count():
        return spark.read.parquet(*copies.follow(spark, source, root, make)).count()

    n = count()
    assert count() == n and seen == [2]
    add(1)
    whole = count()
    assert seen == [2, 2] and whole > n
    first = files.listing(spark, source)[0].path
    files.delete(spark, [first])
    assert count() < whole and seen == [2, 2, 3]
    changed = files.listing(spark, source)[0].path
    local = changed.removeprefix("file:")
    os.utime(local, (1, 1))
    assert count() < whole and seen == [2, 2, 3, 3]


def test_a_broken_delta_is_made_again_and_deltas_merge(spark, growing, tmp_path, monkeypatch):
    folder, add = growing
    source, root = f"{folder}/events.parquet", f"{tmp_path}/copy"
    monkeypatch.setattr(copies, "MOST_DELTAS", 2)

    def make(paths, target):
        spark.read.schema(views.SCHEMAS["events"]).parquet(*paths).select("event_id").write.parquet(target)

    def broken(paths, target):
        make(paths[:1], target)
        raise OSError("no space")

    def merge(folders, target):
        spark.read.parquet(*folders).coalesce(1).write.parquet(target)

    with pytest.raises(OSError):
        copies.follow(spark, source, root, broken)
    for k in range(4):
        if k:
            add(1)  # rows of any kind: each time more files
        folders = copies.follow(spark, source, root, make, merge)
        assert rows_of(spark.read.parquet(*folders)) == rows_of(
            spark.read.parquet(source).select("event_id")
        )
        assert len(folders) == [1, 2, 1, 2][k]


def test_an_empty_source_has_no_folders(spark, tmp_path):
    assert copies.follow(spark, f"{tmp_path}/none", f"{tmp_path}/copy", None) == []


def test_a_sample_reads_its_share_of_files_and_its_interval_holds(spark, sf_dir):
    from tillflow.registry import storage

    sample = storage._user_sample(spark, sf_dir)
    plan = sample._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "slot" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    run = lambda name: {r.category: r for r in registry.queries()[name](spark, "/root/testdata/sf0.01").collect()}
    true, held = run("category_totals"), run("category_sample10_interval")
    inside = [held[c].revenue_low <= float(r.total_revenue) <= held[c].revenue_high for c, r in true.items()]
    assert sum(inside) >= len(inside) - 1
