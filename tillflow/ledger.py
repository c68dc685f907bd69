"""One object for everyday use: a payments table with its queries."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tillflow.plans import customers, reports, revenue, segments
from tillflow.sources import catalog, schemas, tables


class Ledger:
    """Payments stored in a catalog table.

    Reads return lazy DataFrames, so a caller may refine, join or collect them;
    ``as_of`` fixes the moment that look-backs count from (default: now).
    """

    def __init__(
        self, spark: SparkSession, database: str = "default", as_of: datetime | None = None
    ) -> None:
        self.spark = spark
        self.database = database
        self.table = f"{database}.transactions"
        self.as_of = as_of

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def create(self) -> None:
        catalog.create(self.spark, "transactions", self.database)

    # -- writes -------------------------------------------------------------

    def insert_batch(self, rows: Sequence[tuple], columns: Sequence[str] | None = None) -> int:
        """Append rows given as tuples; returns how many were written."""
        return tables.insert_batch(
            self.spark,
            self.table,
            rows,
            columns or customers.PAYMENT_COLUMNS,
            schemas.TRANSACTIONS,
            schemas.TRANSACTION_DEFAULTS,
            month_of="created_at",
        )

    def insert_pandas(self, frame) -> int:
        return tables.insert_pandas(
            self.spark,
            self.table,
            frame,
            schemas.TRANSACTIONS,
            schemas.TRANSACTION_DEFAULTS,
            month_of="created_at",
        )

    def load(self, df: DataFrame, partitions: int | None = None) -> int:
        """Append a DataFrame of any size, sorted for user lookups."""
        return catalog.load(df, "transactions", self.database, partitions)

    # -- reads --------------------------------------------------------------

    def by_user(self, user_id: int, limit: int = 100, offset: int = 0) -> DataFrame:
        return customers.payments_of(self.rows, user_id, limit, offset)

    def revenue_by_merchant(
        self, start: datetime | None = None, end: datetime | None = None, limit: int = 20
    ) -> DataFrame:
        return revenue.merchant_revenue(self.rows, start, end or self.as_of, limit)

    def hourly_stats(self, days: int = 7) -> DataFrame:
        return revenue.hourly_stats(self.rows, days, self.as_of)

    def spending_summary(self, user_id: int) -> DataFrame:
        return customers.spending_summary(self.rows, user_id)

    def daily_revenue(self, days: int = 30) -> DataFrame:
        return revenue.daily_revenue(self.rows, days, self.as_of)

    def category_breakdown(self, days: int = 30) -> DataFrame:
        return segments.category_breakdown(self.rows, days, self.as_of)

    def status_distribution(self, days: int = 7) -> DataFrame:
        return segments.status_distribution(self.rows, days, self.as_of)

    def top_merchants(self, limit: int = 10, days: int = 30) -> DataFrame:
        return revenue.top_merchants(self.rows, limit, days, self.as_of)

    def total_stats(self) -> DataFrame:
        return revenue.total_stats(self.rows)

    def report(self, days: int = 30) -> dict[str, DataFrame]:
        return reports.full(self.rows, days, self.as_of)
