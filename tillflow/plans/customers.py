"""Users: payments, profiles, cohorts, spenders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.checks import not_negative, positive
from tillflow.clock import last_days
from tillflow.functions import money, times
from tillflow.operators.joins import first_seen
from tillflow.operators.ranking import distinct, most_frequent, top, top_per_group

PAYMENT_COLUMNS = [
    "transaction_id",
    "user_id",
    "merchant_id",
    "amount",
    "currency",
    "status",
    "category",
    "payment_method",
    "created_at",
    "processed_at",
]


def payments(txn: DataFrame) -> DataFrame:
    """All payments with the stored columns."""
    return txn.select(*PAYMENT_COLUMNS)


def payments_of(txn: DataFrame, user_id: int, limit: int = 100, offset: int = 0) -> DataFrame:
    """One page of a user's payments, newest first."""
    positive("user_id", user_id)
    positive("limit", limit)
    not_negative("offset", offset)
    mine = txn.where(F.col("user_id") == user_id).select(*PAYMENT_COLUMNS)
    return top(mine, [F.desc("created_at"), F.asc("transaction_id")], limit, offset)


def _of_user(txn: DataFrame, user_id: int | None) -> DataFrame:
    if user_id is None:
        return txn
    return txn.where(F.col("user_id") == positive("user_id", user_id))


def profile(txn: DataFrame, user_id: int | None = None) -> DataFrame:
    """Spending profile of one user, or of every user."""
    grouped = (
        _of_user(txn, user_id)
        .groupBy("user_id")
        .agg(
            F.count("*").alias("total_transactions"),
            money.total("amount").alias("total_spent"),
            money.mean("amount").alias("avg_transaction"),
            F.min("created_at").alias("first_transaction"),
            F.max("created_at").alias("last_transaction"),
        )
        .withColumn("active_days", times.days_between("first_transaction", "last_transaction"))
    )
    return grouped.withColumn(
        "daily_avg", money.ratio("total_spent", F.greatest("active_days", F.lit(1)))
    )


def _usage(txn: DataFrame) -> DataFrame:
    """Payments counted per (user, category) and per (user, merchant) at once."""
    return txn.groupingSets(
        [[txn.user_id, txn.category], [txn.user_id, txn.merchant_id]],
        txn.user_id,
        txn.category,
        txn.merchant_id,
    ).agg(
        F.grouping_id().alias("gid"),
        F.count("*").alias("n"),
        money.total("amount").alias("spent"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )


def _usage_measures() -> list:
    """What the rows of :func:`_usage` say about a user.

    The category rows add up to the totals; the numbers of category and of
    merchant rows are the distinct counts.  Ties go to the smallest value.
    """
    per_category, per_merchant = F.col("gid") == 1, F.col("gid") == 2

    def favorite(where, column: str):
        most = F.struct((-F.col("n")).alias("n"), F.col(column).alias("v"))
        return F.min(F.when(where, most))["v"]

    return [
        F.sum(F.when(per_category, F.col("n"))).alias("total_transactions"),
        F.sum(F.when(per_category, F.col("spent"))).cast(money.TOTAL).alias("total_spent"),
        F.min(F.when(per_category, F.col("first_at"))).alias("first_transaction"),
        F.max(F.when(per_category, F.col("last_at"))).alias("last_transaction"),
        F.count(F.when(per_merchant, 1)).alias("merchants_used"),
        F.count(F.when(per_category, 1)).alias("categories_used"),
        favorite(per_category, "category").alias("favorite_category"),
        favorite(per_merchant, "merchant_id").alias("favorite_merchant"),
    ]


def _days_active():
    return times.whole_days_between("first_transaction", "last_transaction")


def spending_summary(txn: DataFrame, user_id: int) -> DataFrame:
    """One row about a user; zeros and NULLs when the user has no payments."""
    positive("user_id", user_id)
    mine = txn.where(F.col("user_id") == user_id)
    zero = F.lit(0).cast("long")
    return (
        _usage(mine)
        .agg(*_usage_measures())
        .select(
            F.lit(user_id).cast("long").alias("user_id"),
            F.coalesce("total_transactions", zero).alias("total_transactions"),
            F.coalesce("total_spent", zero.cast(money.TOTAL)).alias("total_spent"),
            F.coalesce(money.ratio("total_spent", "total_transactions"), F.lit(0.0)).alias(
                "avg_transaction"
            ),
            "first_transaction",
            "last_transaction",
            F.coalesce(_days_active(), F.lit(0)).alias("days_active"),
            "merchants_used",
            "categories_used",
            "favorite_category",
            F.coalesce("favorite_merchant", zero).alias("favorite_merchant"),
        )
    )


def daily_average(txn: DataFrame) -> DataFrame:
    """Every user with favourites, whole days active and spending per such day."""
    per_user = (
        _usage(txn)
        .groupBy("user_id")
        .agg(*_usage_measures())
        .withColumn("days_active", _days_active())
    )
    per_day = F.when(F.col("days_active") == 0, F.lit(0.0)).otherwise(
        money.ratio("total_spent", "days_active")
    )
    return per_user.select(
        "user_id",
        "total_transactions",
        "total_spent",
        money.ratio("total_spent", "total_transactions").alias("avg_transaction"),
        "first_transaction",
        "last_transaction",
        "favorite_category",
        F.col("favorite_merchant").alias("favorite_merchant_id"),
        "days_active",
        per_day.alias("daily_average"),
    )


def favorite_category(txn: DataFrame) -> DataFrame:
    """Most frequent category of every user."""
    return most_frequent(txn, ["user_id"], "category", "favorite_category")


def cohort_retention(txn: DataFrame) -> DataFrame:
    """Users active n calendar months after their first month."""
    per_month = first_seen(
        txn, "user_id", "created_at", [times.month_start("created_at").alias("month")]
    )
    # (user, month) is unique here, so counting rows counts users.
    return (
        per_month.groupBy(
            times.month_start("first_seen").alias("cohort_month"),
            times.months_between_grid("first_seen", "month").alias("months_since_first"),
        )
        .agg(F.count("*").alias("users"))
        .orderBy("cohort_month", "months_since_first")
    )


def top_spenders(
    txn: DataFrame, n: int = 5, days: int = 30, as_of: datetime | None = None
) -> DataFrame:
    """Users who spent most in each category."""
    positive("n", n)
    spent = (
        last_days(txn, days, as_of)
        .groupBy("category", "user_id")
        .agg(money.total("amount").alias("total_spent"), F.count("*").alias("transactions"))
    )
    order = [F.desc("total_spent"), F.asc("user_id")]
    return top_per_group(spent, ["category"], order, n, "rank_in_category").orderBy(
        "category", "rank_in_category"
    )


def completed_spend(
    txn: DataFrame, limit: int = 100, days: int = 30, as_of: datetime | None = None
) -> DataFrame:
    """Users by completed spending."""
    positive("limit", limit)
    rows = last_days(txn, days, as_of).where(F.col("status") == "completed")
    totals = rows.groupBy("user_id").agg(money.total("amount").alias("total"))
    return top(totals, [F.desc("total"), F.asc("user_id")], limit)


def spend_of(txn: DataFrame, user_id: int | None = None) -> DataFrame:
    """Total per user over rows that are already the latest versions."""
    return _of_user(txn, user_id).groupBy("user_id").agg(money.total("amount").alias("total"))


def active_users_per_category(txn: DataFrame, approx: bool = False) -> DataFrame:
    return txn.groupBy("category").agg(
        distinct("user_id", approx).alias("unique_users"),
        distinct("merchant_id", approx).alias("unique_merchants"),
    )
