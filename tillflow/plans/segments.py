"""Categories and statuses."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.checks import positive
from tillflow.clock import last_days
from tillflow.functions import enums, money, times
from tillflow.functions.sampling import keep_one_in
from tillflow.operators.ranking import distinct, grand_total


def category_performance(
    txn: DataFrame, days: int = 30, as_of: datetime | None = None, approx: bool = False
) -> DataFrame:
    """Categories with their share of revenue and of payments."""
    grouped = (
        last_days(txn, days, as_of)
        .groupBy("category")
        .agg(
            F.count("*").alias("transactions"),
            money.total("amount").alias("revenue"),
            money.mean("amount").alias("avg_transaction"),
            distinct("user_id", approx).alias("unique_users"),
        )
    )
    return (
        grouped.withColumn(
            "revenue_share_pct", money.percent("revenue", grand_total("revenue"))
        )
        .withColumn(
            "transaction_share_pct", money.percent("transactions", grand_total("transactions"))
        )
        .orderBy(F.desc("revenue"), "category")
    )


def category_breakdown(
    txn: DataFrame, days: int = 30, as_of: datetime | None = None, approx: bool = False
) -> DataFrame:
    """Categories with users, merchants and shares."""
    grouped = (
        last_days(txn, days, as_of)
        .groupBy("category")
        .agg(
            F.count("*").alias("transactions"),
            money.total("amount").alias("revenue"),
            money.mean("amount").alias("avg_transaction"),
            distinct("user_id", approx).alias("unique_users"),
            distinct("merchant_id", approx).alias("unique_merchants"),
        )
    )
    return (
        grouped.withColumn(
            "pct_transactions", money.percent("transactions", grand_total("transactions"))
        )
        .withColumn("pct_revenue", money.percent("revenue", grand_total("revenue")))
        .orderBy(F.desc("revenue"), "category")
    )


def category_trends(
    txn: DataFrame, days: int = 365, as_of: datetime | None = None
) -> DataFrame:
    """Revenue per month and category."""
    return (
        last_days(txn, days, as_of)
        .groupBy(times.month_start("created_at").alias("month"), "category")
        .agg(money.total("amount").alias("revenue"), F.count("*").alias("transactions"))
        .orderBy("month", "category")
    )


def category_totals(
    txn: DataFrame, days: int = 365, as_of: datetime | None = None
) -> DataFrame:
    return (
        last_days(txn, days, as_of)
        .groupBy("category")
        .agg(F.count("*").alias("total_count"), money.total("amount").alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def category_totals_sampled(
    txn: DataFrame, one_in: int = 10, days: int = 365, as_of: datetime | None = None
) -> DataFrame:
    """Estimate of :func:`category_totals` from all payments of one user in n."""
    positive("one_in", one_in)
    sample = last_days(txn, days, as_of).where(keep_one_in("user_id", one_in))
    return (
        sample.groupBy("category")
        .agg(
            (F.count("*") * one_in).alias("total_count"),
            (money.total("amount") * one_in).cast(money.TOTAL).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def category_totals_interval(sample: DataFrame, one_in: int, z: float = 1.96) -> DataFrame:
    """Totals of categories estimated from a sample of one user in n, with an interval.

    ``sample`` has all payments of the sampled users.  Users are drawn independently with
    probability 1/n, so the variance of a scaled sum is n (n - 1) times the sum of the squares
    of what each sampled user adds; the interval is z standard errors wide on each side.
    """
    of_user = sample.groupBy("category", "user_id").agg(
        F.count("*").alias("n"), money.total("amount").alias("spent")
    )
    spread = F.sqrt(F.sum(F.pow(F.col("spent").cast("double"), 2)) * one_in * (one_in - 1)) * z
    revenue = F.sum("spent").cast("double") * one_in
    return of_user.groupBy("category").agg(
        (F.sum("n") * one_in).alias("total_count"),
        F.round(revenue, 2).alias("total_revenue"),
        F.round(revenue - spread, 2).alias("revenue_low"),
        F.round(revenue + spread, 2).alias("revenue_high"),
    )


def heavy_groups(txn: DataFrame, min_rows: int, keys=("category", "status")) -> DataFrame:
    """Groups with more than ``min_rows`` payments."""
    positive("min_rows", min_rows)
    return (
        txn.groupBy(*keys)
        .agg(F.count("*").alias("transactions"), money.total("amount").alias("revenue"))
        .where(F.col("transactions") > min_rows)
        .orderBy(F.desc("transactions"), *keys)
    )


def _by_status(txn: DataFrame, days: int, as_of) -> DataFrame:
    grouped = (
        last_days(txn, days, as_of)
        .groupBy("status")
        .agg(F.count("*").alias("transactions"), money.total("amount").alias("total_amount"))
    )
    return grouped.withColumn(
        "pct_of_total", money.percent("transactions", grand_total("transactions"))
    )


def status_funnel(txn: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """Statuses in life-cycle order."""
    return _by_status(txn, days, as_of).orderBy(enums.life_cycle_order("status"))


def status_distribution(
    txn: DataFrame, days: int = 7, as_of: datetime | None = None
) -> DataFrame:
    """Statuses, most frequent first."""
    return _by_status(txn, days, as_of).orderBy(F.desc("transactions"), "status")


def failed_analysis(txn: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """Failures per day and category with their share of all failures.

    The total of the period is the total of the groups, so it is taken from
    the grouped rows instead of a second scan.
    """
    grouped = (
        last_days(txn, days, as_of)
        .where(F.col("status") == "failed")
        .groupBy(times.day("created_at").alias("txn_date"), "category")
        .agg(F.count("*").alias("failed_count"), money.total("amount").alias("failed_amount"))
    )
    return grouped.withColumn(
        "pct_of_failures", money.percent("failed_count", grand_total("failed_count"))
    ).orderBy(F.desc("failed_count"), "txn_date", "category")
