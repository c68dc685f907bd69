"""Revenue over time and by merchant."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.checks import positive
from tillflow.clock import last_days, last_hours_rolling, now, time_range
from tillflow.functions import money, times
from tillflow.operators.ranking import distinct, top, top_ranked


def _count():
    return F.count("*")


def total_stats(txn: DataFrame, approx: bool = False) -> DataFrame:
    """One row of totals; zeros and NULL times for an empty table."""
    return txn.agg(
        _count().alias("total_transactions"),
        F.coalesce(money.total("amount"), F.lit(0).cast(money.TOTAL)).alias("total_volume"),
        distinct("user_id", approx).alias("total_users"),
        distinct("merchant_id", approx).alias("total_merchants"),
        F.min("created_at").alias("earliest_transaction"),
        F.max("created_at").alias("latest_transaction"),
    )


def daily_revenue(
    txn: DataFrame, days: int = 30, as_of: datetime | None = None, approx: bool = False
) -> DataFrame:
    """Revenue per day, newest day first."""
    return (
        last_days(txn, days, as_of)
        .groupBy(times.day("created_at").alias("txn_date"))
        .agg(
            _count().alias("total_transactions"),
            money.total("amount").alias("total_revenue"),
            money.mean("amount").alias("avg_transaction"),
            F.min("amount").alias("min_transaction"),
            F.max("amount").alias("max_transaction"),
            distinct("user_id", approx).alias("unique_customers"),
            distinct("merchant_id", approx).alias("unique_merchants"),
        )
        .orderBy(F.desc("txn_date"))
    )


def _by_merchant(txn: DataFrame, approx: bool) -> DataFrame:
    return txn.groupBy("merchant_id").agg(
        _count().alias("transaction_count"),
        money.total("amount").alias("total_revenue"),
        money.mean("amount").alias("avg_transaction"),
        distinct("user_id", approx).alias("unique_customers"),
    )


def _revenue_order():
    return [F.desc("total_revenue"), F.asc("merchant_id")]


def merchant_revenue(
    txn: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    limit: int = 20,
    approx: bool = False,
) -> DataFrame:
    """Completed revenue per merchant between two moments, both included."""
    positive("limit", limit)
    hi = now(end)
    lo = start or hi - timedelta(days=30)
    rows = time_range(txn, lo, hi).where(F.col("status") == "completed")
    grouped = rows.groupBy("merchant_id").agg(
        _count().alias("transaction_count"),
        money.total("amount").alias("total_revenue"),
        money.mean("amount").alias("avg_transaction"),
        F.min("amount").alias("min_transaction"),
        F.max("amount").alias("max_transaction"),
        distinct("user_id", approx).alias("unique_customers"),
    )
    return top(grouped, _revenue_order(), limit)


def top_merchants(
    txn: DataFrame,
    limit: int = 10,
    days: int = 30,
    as_of: datetime | None = None,
    completed_only: bool = True,
    approx: bool = False,
) -> DataFrame:
    """Merchants ranked by revenue."""
    positive("limit", limit)
    rows = last_days(txn, days, as_of)
    if completed_only:
        rows = rows.where(F.col("status") == "completed")
    return top_ranked(_by_merchant(rows, approx), _revenue_order(), limit, "revenue_rank")


def merchant_leaders(txn: DataFrame, limit: int = 10, approx: bool = False) -> DataFrame:
    """Merchants by revenue over the whole table and every status."""
    return top(_by_merchant(txn, approx), _revenue_order(), limit)


def hourly_pattern(txn: DataFrame, days: int = 90, as_of: datetime | None = None) -> DataFrame:
    """Volume by hour of the day and day of the week (Monday = 1)."""
    return (
        last_days(txn, days, as_of)
        .groupBy(
            times.hour_of_day("created_at").alias("hour_of_day"),
            times.iso_weekday("created_at").alias("day_of_week"),
        )
        .agg(
            _count().alias("transactions"),
            money.total("amount").alias("revenue"),
            money.mean("amount").alias("avg_amount"),
        )
        .orderBy("day_of_week", "hour_of_day")
    )


def _by_hour(txn: DataFrame, days: int, as_of, approx: bool) -> DataFrame:
    return (
        last_hours_rolling(txn, days, as_of)
        .groupBy(times.hour_start("created_at").alias("hour"))
        .agg(
            _count().alias("transactions"),
            money.total("amount").alias("revenue"),
            money.mean("amount").alias("avg_amount"),
            distinct("user_id", approx).alias("unique_users"),
            distinct("merchant_id", approx).alias("unique_merchants"),
        )
    )


def hourly_stats(
    txn: DataFrame, days: int = 7, as_of: datetime | None = None, approx: bool = False
) -> DataFrame:
    """Hourly series of the last ``days`` times 24 hours, newest hour first."""
    return _by_hour(txn, days, as_of, approx).orderBy(F.desc("hour"))


def recent_hours(
    txn: DataFrame,
    hours: int = 24,
    days: int = 7,
    as_of: datetime | None = None,
    approx: bool = False,
) -> DataFrame:
    """Newest hours of :func:`hourly_stats`."""
    return top(_by_hour(txn, days, as_of, approx), [F.desc("hour")], hours)


def rolling_average(
    txn: DataFrame, days: int = 60, as_of: datetime | None = None, rows: int = 7
) -> DataFrame:
    """Daily revenue with its moving average over the last ``rows`` days that
    have payments.  The window runs over at most one row per day."""
    positive("rows", rows)
    daily = (
        last_days(txn, days, as_of)
        .groupBy(times.day("created_at").alias("txn_date"))
        .agg(money.total("amount").alias("daily_revenue"))
    )
    w = Window.orderBy("txn_date").rowsBetween(1 - rows, 0)
    average = money.ratio(
        F.sum("daily_revenue").over(w), F.count("daily_revenue").over(w)
    )
    name = f"rolling_{rows}d_avg"
    return (
        daily.withColumn(name, average)
        .withColumn("deviation", F.col("daily_revenue").cast("double") - F.col(name))
        .orderBy("txn_date")
    )


def weekly_growth(
    txn: DataFrame,
    days: int = 90,
    as_of: datetime | None = None,
    first_day: str = "sunday",
) -> DataFrame:
    """Revenue per week with the change to the week before (NULL at the start)."""
    weekly = (
        last_days(txn, days, as_of)
        .groupBy(times.week_start("created_at", first_day).alias("week_start"))
        .agg(money.total("amount").alias("revenue"))
    )
    previous = F.lag("revenue", 1).over(Window.orderBy("week_start"))
    change = money.ratio(
        F.col("revenue") - F.col("prev_week_revenue"), "prev_week_revenue"
    )
    return (
        weekly.withColumn("prev_week_revenue", previous)
        .withColumn("wow_growth_pct", F.round(change * 100, 2))
        .orderBy("week_start")
    )
