"""Report tables: numbers of the other plans as display text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import money, times
from tillflow.plans import customers, revenue, segments


def summary(txn: DataFrame) -> DataFrame:
    s = revenue.total_stats(txn)
    return s.select(
        money.grouped("total_transactions").alias("total_transactions"),
        money.dollars("total_volume").alias("total_volume"),
        money.grouped("total_users").alias("total_users"),
        money.grouped("total_merchants").alias("total_merchants"),
        times.to_text("earliest_transaction").alias("data_from"),
        times.to_text("latest_transaction").alias("data_to"),
    )


def daily(txn: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    """A line per day, newest first, and a last line of totals."""
    d = revenue.daily_revenue(txn, days, as_of)
    lines = d.groupingSets([[d.txn_date], []], d.txn_date).agg(
        F.grouping_id().alias("is_total"),
        F.sum("total_transactions").alias("n"),
        F.sum("total_revenue").alias("revenue"),
        F.max("avg_transaction").alias("average"),
        F.max("unique_customers").alias("customers"),
        F.max("unique_merchants").alias("merchants"),
    )
    of_day = F.col("is_total") == 0
    return lines.orderBy("is_total", F.desc("txn_date")).select(
        F.when(of_day, F.date_format("txn_date", "yyyy-MM-dd")).otherwise("Total").alias("date"),
        money.grouped("n").alias("transactions"),
        money.dollars("revenue").alias("revenue"),
        F.when(of_day, money.dollars("average")).alias("avg_txn"),
        F.when(of_day, money.grouped("customers")).alias("customers"),
        F.when(of_day, money.grouped("merchants")).alias("merchants"),
    )


def user(txn: DataFrame, user_id: int) -> DataFrame:
    s = customers.spending_summary(txn, user_id)
    return s.select(
        money.grouped("total_transactions").alias("total_transactions"),
        money.dollars("total_spent").alias("total_spent"),
        money.dollars("avg_transaction").alias("average_transaction"),
        "days_active",
        "merchants_used",
        "categories_used",
        F.coalesce("favorite_category", F.lit("N/A")).alias("favorite_category"),
        F.concat(F.lit("#"), F.col("favorite_merchant").cast("string")).alias(
            "favorite_merchant"
        ),
        times.to_text("first_transaction").alias("first_transaction"),
        times.to_text("last_transaction").alias("last_transaction"),
    )


def merchants(
    txn: DataFrame, limit: int = 10, days: int = 30, as_of: datetime | None = None
) -> DataFrame:
    m = revenue.top_merchants(txn, limit, days, as_of)
    return m.orderBy("revenue_rank").select(
        F.col("revenue_rank").alias("rank"),
        F.concat(F.lit("#"), F.col("merchant_id").cast("string")).alias("merchant"),
        money.grouped("transaction_count").alias("transactions"),
        money.dollars("total_revenue").alias("revenue"),
        money.dollars("avg_transaction").alias("avg_txn"),
        money.grouped("unique_customers").alias("customers"),
    )


def categories(txn: DataFrame, days: int = 30, as_of: datetime | None = None) -> DataFrame:
    c = segments.category_breakdown(txn, days, as_of)
    return c.select(
        "category",
        money.grouped("transactions").alias("transactions"),
        money.percent_text("pct_transactions").alias("pct_txns"),
        money.dollars("revenue").alias("revenue"),
        money.percent_text("pct_revenue").alias("pct_rev"),
        money.dollars("avg_transaction").alias("avg_txn"),
    )


def statuses(txn: DataFrame, days: int = 7, as_of: datetime | None = None) -> DataFrame:
    s = segments.status_distribution(txn, days, as_of)
    return s.select(
        F.upper("status").alias("status"),
        money.grouped("transactions").alias("transactions"),
        money.percent_text("pct_of_total").alias("pct_of_total"),
        money.dollars("total_amount").alias("total_amount"),
    )


def hourly(
    txn: DataFrame, days: int = 7, as_of: datetime | None = None, hours: int = 24
) -> DataFrame:
    h = revenue.recent_hours(txn, hours, days, as_of)
    return h.orderBy(F.desc("hour")).select(
        times.hour_text("hour").alias("hour"),
        money.grouped("transactions").alias("transactions"),
        money.dollars("revenue").alias("revenue"),
        money.dollars("avg_amount").alias("avg_txn"),
        money.grouped("unique_users").alias("users"),
    )


def full(txn: DataFrame, days: int = 30, as_of: datetime | None = None) -> dict[str, DataFrame]:
    """The sections of the complete report, in order."""
    return {
        "summary": summary(txn),
        "revenue": daily(txn, min(days, 14), as_of),
        "merchants": merchants(txn, 10, days, as_of),
        "categories": categories(txn, days, as_of),
        "statuses": statuses(txn, min(days, 7), as_of),
    }
