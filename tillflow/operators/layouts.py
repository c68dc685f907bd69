"""Alternate layouts of a table: re-sorted copies and pre-grouped summaries.

The caller names the layout to read.  A layout takes deltas: what ``build`` makes of new
rows alone is added beside what is stored, and reading merges them (``copies.follow`` does
so for the files of a table).  Layouts are dropped by removing their folder or table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.checks import positive
from tillflow.functions import times
from tillflow.functions.sampling import sample_slot
from tillflow.operators.ranking import top
from tillflow.operators.states import (
    Measure,
    build_states,
    count_of,
    mean_of,
    merge_states,
    read_states,
    sum_of,
)
from tillflow.sources.tables import clustered

COPIED = [
    "transaction_id",
    "user_id",
    "merchant_id",
    "amount",
    "currency",
    "status",
    "category",
    "created_at",
]


@dataclass(frozen=True)
class SortedLayout:
    """A full copy in another order; its file statistics skip by that order."""

    name: str
    order: Sequence[str]

    def build(self, txn: DataFrame, partitions: int | None = None) -> DataFrame:
        return clustered(txn.select(*COPIED), self.order, partitions)

    def merge(self, stored: DataFrame, partitions: int | None = None) -> DataFrame:
        """The rows of several deltas of the copy in one order."""
        return clustered(stored, self.order, partitions)


@dataclass(frozen=True)
class GroupedLayout:
    """A stored aggregation; averages are kept as sum and count."""

    name: str
    keys: Sequence
    key_names: Sequence[str]
    measures: Sequence[Measure]

    def build(self, txn: DataFrame, partitions: int | None = None) -> DataFrame:
        grouped = build_states(txn, [k() for k in self.keys], self.measures)
        return grouped.coalesce(partitions) if partitions else grouped

    def merge(self, stored: DataFrame, partitions: int | None = None) -> DataFrame:
        """The states of several deltas, each group once."""
        merged = merge_states(stored, list(self.key_names), self.measures)
        return merged.coalesce(partitions) if partitions else merged

    def read(self, stored: DataFrame) -> DataFrame:
        """Results, whatever number of deltas hold a group's states."""
        return read_states(stored, list(self.key_names), self.measures)


@dataclass(frozen=True)
class SampledLayout:
    """A copy in ``slots`` folders by a checksum of a key: a share of keys reads a share of files."""

    name: str
    key: str
    slots: int = 10

    def save(self, txn: DataFrame, path: str) -> None:
        """Write the copy, each slot sorted by the key and spread by it."""
        rows = txn.select(*COPIED).withColumn("slot", sample_slot(self.key, self.slots))
        clustered(rows, ("slot", self.key)).write.partitionBy("slot").parquet(path)

    def sample(self, stored: DataFrame, slots: int = 1) -> DataFrame:
        """All rows of about ``slots / self.slots`` of the keys."""
        return stored.where(F.col("slot") < positive("slots", slots)).drop("slot")


BY_USER_SAMPLE = SampledLayout("by_user_sample", "user_id")
BY_MERCHANT = SortedLayout("by_merchant", ("merchant_id", "created_at", "transaction_id"))
BY_CATEGORY = SortedLayout("by_category", ("category", "created_at", "transaction_id"))


def daily_merchant() -> GroupedLayout:
    return GroupedLayout(
        "daily_merchant",
        (lambda: F.col("merchant_id"), lambda: times.day("created_at").alias("txn_date")),
        ("merchant_id", "txn_date"),
        (count_of("txn_count"), sum_of("total_amount"), mean_of("avg_amount")),
    )


def hourly_status() -> GroupedLayout:
    return GroupedLayout(
        "hourly_status",
        (lambda: F.col("status"), lambda: times.hour_start("created_at").alias("hour")),
        ("status", "hour"),
        (count_of("txn_count"), sum_of("total_amount")),
    )


def materialize(layout, txn: DataFrame, path: str, partitions: int | None = None) -> None:
    """(Re)build a layout for all existing rows."""
    layout.build(txn, partitions).write.mode("overwrite").parquet(path)


def materialize_table(layout, txn: DataFrame, table: str, partitions: int | None = None) -> None:
    """As :func:`materialize`, into a catalog table; dropping that table drops the layout."""
    layout.build(txn, partitions).write.mode("overwrite").format("parquet").saveAsTable(table)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def newest_of_merchant(by_merchant: DataFrame, merchant_id: int, n: int = 100) -> DataFrame:
    """Newest payments of a merchant from the merchant-sorted copy."""
    mine = by_merchant.where(F.col("merchant_id") == positive("merchant_id", merchant_id))
    return top(mine, [F.desc("created_at"), F.asc("transaction_id")], n)
