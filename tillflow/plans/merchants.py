"""Merchants with their names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.checks import positive
from tillflow.clock import last_days
from tillflow.functions import money
from tillflow.operators.joins import enrich, lookup
from tillflow.operators.ranking import distinct, top_ranked


def merchant_summary(
    txn: DataFrame,
    merchants: DataFrame,
    limit: int = 20,
    days: int = 30,
    as_of: datetime | None = None,
    approx: bool = False,
) -> DataFrame:
    """Best merchants with their names (NULL when unknown).

    Names are joined to the ranked rows, not to the payments.
    """
    positive("limit", limit)
    grouped = (
        last_days(txn, days, as_of)
        .where(F.col("status") == "completed")
        .groupBy("merchant_id")
        .agg(
            money.total("amount").alias("total_revenue"),
            F.count("*").alias("total_transactions"),
            distinct("user_id", approx).alias("unique_customers"),
            money.mean("amount").alias("avg_transaction"),
        )
    )
    order = [F.desc("total_revenue"), F.asc("merchant_id")]
    best = top_ranked(grouped, order, limit, "revenue_rank")
    named = enrich(
        best, merchants, "merchant_id", {"name": "merchant_name"}, "left", broadcast_bytes=0
    )
    return named.orderBy("revenue_rank")


def with_names(txn: DataFrame, merchants: DataFrame, how: str = "inner") -> DataFrame:
    """Payments with the merchant's name and country."""
    columns = {"name": "merchant_name", "country_code": "merchant_country"}
    return enrich(txn, merchants, "merchant_id", columns, how)


def in_usd(txn: DataFrame, rates: DataFrame) -> DataFrame:
    """Payments with the amount converted by a table of rates (missing = 1)."""
    found = lookup(txn, rates, "currency", "rate_to_usd", "rate_to_usd", default="1")
    usd = (F.col("amount") * F.col("rate_to_usd")).cast(money.AMOUNT)
    return found.withColumn("amount_usd", usd)
