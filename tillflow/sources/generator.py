"""Random but repeatable payments, made in parallel from row ids.

Every value is a hash of (seed, column, row id), so the rows do not depend on
how many tasks make them, and a task that runs again makes the same rows.
"""

from __future__ import annotations

import secrets
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.checks import not_negative, positive
from tillflow.clock import moment, now
from tillflow.functions.enums import TERMINAL_STATUSES
from tillflow.sources.schemas import (
    CATEGORY_AMOUNTS,
    CURRENCIES,
    PAYMENT_METHODS,
    STATUS_WEIGHTS,
)

# Fixed value of the size estimate.
BYTES_PER_ROW = 120


@dataclass(frozen=True)
class Generator:
    """Without a seed each generator draws its own, so that ids of two loads differ."""

    users: int = 10_000
    merchants: int = 1_000
    days: int = 90
    seed: int | None = None
    as_of: datetime | None = None

    def __post_init__(self) -> None:
        positive("users", self.users)
        positive("merchants", self.merchants)
        positive("days", self.days)
        if self.seed is None:
            object.__setattr__(self, "seed", secrets.randbits(63))
        if isinstance(self.seed, bool) or not isinstance(self.seed, int):
            raise ValueError(f"seed must be an integer, got {type(self.seed).__name__}")

    def _hash(self, column: str, row: Column) -> Column:
        return F.xxhash64(F.lit(self.seed), F.lit(column), row)

    def _uniform(self, column: str, row: Column) -> Column:
        """Number in [0, 1) with 53 random bits."""
        return F.shiftrightunsigned(self._hash(column, row), 11) / F.lit(float(1 << 53))

    def _below(self, column: str, row: Column, n: int) -> Column:
        return F.pmod(self._hash(column, row), F.lit(n))

    def _choice(self, column: str, row: Column, values: list[str]) -> Column:
        position = (self._below(column, row, len(values)) + 1).cast("int")
        return F.element_at(F.array(*[F.lit(v) for v in values]), position)

    def _status(self, row: Column) -> Column:
        draw = self._uniform("status", row) * sum(STATUS_WEIGHTS.values())
        names, edges, edge = list(STATUS_WEIGHTS), [], 0
        for weight in STATUS_WEIGHTS.values():
            edge += weight
            edges.append(edge)
        result = F.lit(names[-1])
        for name, upper in reversed(list(zip(names[:-1], edges[:-1]))):
            result = F.when(draw < upper, F.lit(name)).otherwise(result)
        return result

    def _bound(self, category: Column, index: int) -> Column:
        result = F.lit(None)
        for name, bounds in CATEGORY_AMOUNTS.items():
            result = F.when(category == name, F.lit(bounds[index])).otherwise(result)
        return result

    def from_ids(
        self,
        ids: DataFrame,
        id_column: str = "id",
        user_id: int | None = None,
        merchant_id: int | None = None,
        keep: Sequence[str] = (),
    ) -> DataFrame:
        """One payment per row id, with the ``keep`` columns of the ids."""
        row = F.col(id_column)
        end = now(self.as_of)
        seconds = self._uniform("created_at", row) * F.lit(float(self.days * 86400))
        start = moment(end - timedelta(days=self.days))
        created = start + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), F.floor(seconds).cast("decimal(18,6)")
        )
        user = F.lit(user_id) if user_id else self._below("user", row, self.users) + 1
        merchant = (
            F.lit(merchant_id) if merchant_id else self._below("merchant", row, self.merchants) + 1
        )
        base = ids.select(
            *keep,
            row.alias("_row"),
            F.concat_ws("-", F.lit("txn"), F.lit(str(self.seed)), row.cast("string")).alias(
                "transaction_id"
            ),
            user.cast("long").alias("user_id"),
            merchant.cast("long").alias("merchant_id"),
            self._choice("category", row, list(CATEGORY_AMOUNTS)).alias("category"),
            self._choice("currency", row, CURRENCIES).alias("currency"),
            self._choice("payment_method", row, PAYMENT_METHODS).alias("payment_method"),
            self._status(row).alias("status"),
            created.alias("created_at"),
        )
        low, high = (self._bound(F.col("category"), i) for i in (0, 1))
        amount = low + (high - low) * self._uniform("amount", F.col("_row"))
        delay = F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), self._below("delay", F.col("_row"), 60) + 1
        )
        processed = F.when(
            F.col("status").isin(*TERMINAL_STATUSES), F.col("created_at") + delay
        )
        return base.select(
            *keep,
            "transaction_id",
            "user_id",
            "merchant_id",
            F.round(amount, 2).cast("decimal(18,2)").alias("amount"),
            "currency",
            "status",
            "category",
            "payment_method",
            "created_at",
            processed.alias("processed_at"),
        )

    def rows(self, spark: SparkSession, size: int, tasks: int | None = None) -> DataFrame:
        return self.from_ids(spark.range(0, positive("size", size), 1, tasks))

    def batches(self, spark: SparkSession, total_rows: int, batch_size: int = 10_000) -> DataFrame:
        """All rows with a ``batch_id``; the last batch may be smaller."""
        not_negative("total_rows", total_rows)
        ids = with_batch_id(spark.range(total_rows), "id", batch_size)
        return self.from_ids(ids, keep=["batch_id"])

    def for_user(self, spark: SparkSession, user_id: int, count: int = 50) -> DataFrame:
        return self.from_ids(
            spark.range(positive("count", count)), user_id=positive("user_id", user_id)
        )

    def for_merchant(self, spark: SparkSession, merchant_id: int, count: int = 100) -> DataFrame:
        return self.from_ids(
            spark.range(positive("count", count)),
            merchant_id=positive("merchant_id", merchant_id),
        )


def with_batch_id(ids: DataFrame, id_column: str = "id", batch_size: int = 10_000) -> DataFrame:
    """Batch number of consecutive row ids."""
    positive("batch_size", batch_size)
    return ids.withColumn("batch_id", F.floor(F.col(id_column) / batch_size).cast("long"))


def size_estimate(counts: DataFrame, rows: str = "row_count") -> DataFrame:
    """Stored size expected for a number of rows, plain and compressed 5-10 times."""
    plain = F.col(rows).cast("long") * BYTES_PER_ROW
    mb = F.lit(1024.0 * 1024.0)
    return counts.select(
        "*",
        plain.alias("estimated_uncompressed_bytes"),
        F.round(plain / mb, 2).alias("estimated_uncompressed_mb"),
        (plain / F.lit(10.0)).alias("estimated_compressed_bytes_low"),
        (plain / F.lit(5.0)).alias("estimated_compressed_bytes_high"),
        F.round(plain / F.lit(10.0) / mb, 2).alias("estimated_compressed_mb_low"),
        F.round(plain / F.lit(5.0) / mb, 2).alias("estimated_compressed_mb_high"),
    )
