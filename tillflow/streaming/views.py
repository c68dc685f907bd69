"""Definitions of the maintained views.

A view turns new payments into rows for its target (``delta``) and reads the
target back (``read``).  The same two functions serve a backfill in batch, a
delta of new rows, and every micro-batch of a stream: grouped views store
mergeable states, so rows may arrive late, in any order and in any split.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions import money, times
from tillflow.operators.states import (
    Measure,
    build_states,
    count_of,
    distinct_of,
    exact_distinct_of,
    exact_quantile_of,
    mean_of,
    merge_states,
    quantile_of,
    read_states,
    sum_of,
    top_of,
)


# Distinct counts of views are exact at any size: views of few large groups keep bitmaps of
# ids, those of many small ones the ids themselves.  ``payment_metrics`` keeps quantiles of
# many groups as sketches, which are exact for few amounts only; those of ``category_stats``
# are exact.


@dataclass(frozen=True)
class RowView:
    """A view that maps each payment to one row."""

    name: str
    columns: Callable[[], list]
    month_of: str = "created_at"

    def delta(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.columns())

    @property
    def keys(self) -> tuple[str, ...]:
        """What compacted files are ranged by."""
        return (self.month_of,)

    def merge(self, target: DataFrame) -> DataFrame:
        """The same rows in ranges of time, so that the files of many batches become few."""
        return target.drop("batch_id", "ym").repartitionByRange(*self.keys)

    def read(self, target: DataFrame) -> DataFrame:
        return target


@dataclass(frozen=True)
class GroupedView:
    """A view that keeps one row of states per key."""

    name: str
    keys: dict[str, Callable[[], Column]]
    measures: Sequence[Measure] = field(default_factory=tuple)
    where: Callable[[], Column] | None = None
    month_of: str | None = None

    def delta(self, rows: DataFrame) -> DataFrame:
        if self.where is not None:
            rows = rows.where(self.where())
        keys = [make().alias(name) for name, make in self.keys.items()]
        return build_states(rows, keys, self.measures)

    def merge(self, target: DataFrame) -> DataFrame:
        """Fewer rows of states with the same meaning."""
        return merge_states(target, list(self.keys), self.measures)

    def read(self, target: DataFrame) -> DataFrame:
        return read_states(target, list(self.keys), self.measures)

    def roll_up(self, target: DataFrame, keys: Sequence, name: str | None = None) -> DataFrame:
        """States at coarser keys, e.g. hours merged into days."""
        return merge_states(target, keys, self.measures)


def _enriched_columns() -> list:
    return [
        "transaction_id",
        "user_id",
        "merchant_id",
        "amount",
        money.to_usd("amount", "currency").alias("amount_usd"),
        F.col("status").cast("string").alias("status"),
        "category",
        times.hour_of_day("created_at").alias("hour_of_day"),
        times.iso_weekday("created_at").alias("day_of_week"),
        times.is_weekend("created_at").alias("is_weekend"),
        "created_at",
    ]


def enriched() -> RowView:
    return RowView("transactions_enriched", _enriched_columns)


def hourly_revenue() -> GroupedView:
    return GroupedView(
        "hourly_revenue",
        {
            "merchant_id": lambda: F.col("merchant_id"),
            "category": lambda: F.col("category"),
            "hour": lambda: times.hour_start("created_at"),
        },
        (
            sum_of("total_amount"),
            count_of("transaction_count"),
            exact_distinct_of("unique_users", "user_id"),
            mean_of("avg_amount"),
        ),
        month_of="hour",
    )


def user_spending() -> GroupedView:
    return GroupedView(
        "user_spending",
        {
            "user_id": lambda: F.col("user_id"),
            "spending_date": lambda: times.day("created_at"),
            "currency": lambda: F.col("currency"),
        },
        (sum_of("total_spent"), count_of("transaction_count")),
        where=lambda: F.col("status").isin("completed", "processing"),
        month_of="spending_date",
    )


def category_stats() -> GroupedView:
    return GroupedView(
        "category_stats",
        {
            "category": lambda: F.col("category"),
            "status": lambda: F.col("status").cast("string"),
            "stat_date": lambda: times.day("created_at"),
        },
        (
            sum_of("total_amount"),
            count_of("transaction_count"),
            exact_distinct_of("unique_merchants", "merchant_id", dense=True),
            exact_distinct_of("unique_users", "user_id", dense=True),
            exact_quantile_of("median_amount", 0.5),
            exact_quantile_of("p95_amount", 0.95),
        ),
        month_of="stat_date",
    )


def daily_merchant_summary() -> GroupedView:
    return GroupedView(
        "daily_merchant_summary",
        {
            "merchant_id": lambda: F.col("merchant_id"),
            "date": lambda: times.day("created_at"),
        },
        (
            sum_of("revenue"),
            count_of("orders"),
            exact_distinct_of("customers", "user_id"),
            mean_of("avg_order"),
        ),
        where=lambda: F.col("status") == "completed",
        month_of="date",
    )


def daily_summary() -> GroupedView:
    return GroupedView(
        "daily_summary",
        {"date": lambda: times.day("created_at")},
        (count_of("orders"), sum_of("revenue")),
        where=lambda: F.col("status") == "completed",
        month_of="date",
    )


def user_favorites() -> GroupedView:
    """What each user buys most, by week."""
    return GroupedView(
        "user_favorites",
        {
            "user_id": lambda: F.col("user_id"),
            "week": lambda: times.week_start("created_at", "monday"),
        },
        (top_of("favorite", "category"), count_of("payments")),
        month_of="week",
    )


def payment_metrics(sketches: bool = False) -> GroupedView:
    """Daily metric states per merchant, category and currency.

    ``sketches`` keeps users as sketches too, in the one row of a group.
    """
    from tillflow.operators.states import max_of, min_of

    return GroupedView(
        "payment_metrics_sketched" if sketches else "payment_metrics",
        {
            "merchant_id": lambda: F.col("merchant_id"),
            "category": lambda: F.col("category"),
            "currency": lambda: F.col("currency"),
            "metric_date": lambda: times.day("created_at"),
        },
        (
            sum_of("total_amount"),
            count_of("transaction_count"),
            mean_of("avg_amount"),
            min_of("min_amount"),
            max_of("max_amount"),
            distinct_of("unique_users", "user_id")
            if sketches
            else exact_distinct_of("unique_users", "user_id"),
            quantile_of("amount_p50", 0.5),
            quantile_of("amount_p99", 0.99),
        ),
        month_of="metric_date",
    )


def by_merchant() -> GroupedView:
    return GroupedView(
        "by_merchant", {"merchant_id": lambda: F.col("merchant_id")}, (sum_of("total_amount"),)
    )


def by_category() -> GroupedView:
    return GroupedView(
        "by_category", {"category": lambda: F.col("category")}, (sum_of("total_amount"),)
    )


def by_user() -> GroupedView:
    return GroupedView(
        "by_user", {"user_id": lambda: F.col("user_id")}, (sum_of("total_amount"),)
    )
