"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
Each query runs once to warm up and three times for the median; results go to
Spark's no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillflow import registry  # noqa: E402
from tillflow.session import local_session  # noqa: E402

HEADLINE = [
    "daily_revenue",
    "top_merchants",
    "hourly_stats",
    "rolling_7d",
    "wow_growth_monday",
    "category_breakdown",
    "cohort_retention",
    "top_spenders_per_category",
    "user_daily_average",
    "quantiles_exact",
    "replacing_final",
    "replacing_lines",
    "versioned_collapsing_final",
    "metrics_state_build",
    "state_merge_full",
    "state_merge_full_sketches",
    "aggregate_raw_full",
    "mv_hourly_revenue",
    "mv_user_spending",
    "mv_category_stats",
    "hourly_revenue_read",
    "layout_daily_merchant",
    "ttl_rollup",
    "usd_by_rates",
]


def aggregate_raw_full(spark, sf_dir):
    """What ``state_merge_full`` computes, straight from the rows."""
    from pyspark.sql import functions as F

    from tillflow.clock import last_days
    from tillflow.functions import money
    from tillflow.registry.analytics import AS_OF
    from tillflow.sources import views

    return (
        last_days(views.txn(spark, sf_dir), 30, AS_OF)
        .groupBy("merchant_id", "category")
        .agg(
            money.total("amount").alias("total_revenue"),
            money.mean("amount").alias("average_transaction"),
            F.min("amount").alias("smallest_transaction"),
            F.max("amount").alias("largest_transaction"),
            F.count("*").alias("total_transactions"),
        )
    )


def seconds(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def ingested(spark, sf_dir) -> tuple[int, float]:
    """Rows and seconds of a load of all payments into a sorted, partitioned table."""
    from tillflow.sources import catalog, tables, views

    spark.sql("CREATE DATABASE IF NOT EXISTS tillflow_bench")
    name = catalog.create(spark, "transactions", "tillflow_bench")
    try:
        start = time.perf_counter()
        rows = catalog.load(views.txn(spark, sf_dir), "transactions", "tillflow_bench")
        return rows, time.perf_counter() - start
    finally:
        tables.drop_table(spark, name)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    warehouse = tempfile.mkdtemp(prefix="tillflow-bench-")
    spark = local_session(
        cpus, int(cpus) if cpus.isdigit() else 8, {"spark.sql.warehouse.dir": warehouse}
    )
    known = {**registry.queries(), "aggregate_raw_full": aggregate_raw_full}
    times = {}
    for name in HEADLINE:
        query = known[name]
        seconds(query, spark, sf_dir)
        times[name] = round(statistics.median(seconds(query, spark, sf_dir) for _ in range(3)), 4)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    ingested(spark, sf_dir)
    loaded, took = ingested(spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "lineitem_rows": rows,
                "load_rows": loaded,
                "load_rows_per_sec": round(loaded / took),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
