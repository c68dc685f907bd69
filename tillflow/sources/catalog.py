"""The tables of the payment domain and the job that creates them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from tillflow.functions.times import week_start, yyyymm, yyyymmdd
from tillflow.sources import schemas, tables


@dataclass(frozen=True)
class Key:
    """A partition key: what is taken of a column (month, day, week or value), and its name."""

    name: str
    of: str
    taken: str = "value"

    def column(self) -> Column:
        return self._of(F.col(self.of)).alias(self.name)

    def field(self, schema: StructType) -> StructField:
        kinds = {"month": IntegerType(), "day": IntegerType(), "week": DateType()}
        return StructField(self.name, kinds.get(self.taken) or schema[self.of].dataType)

    def _of(self, value: Column) -> Column:
        takes = {"month": yyyymm, "day": yyyymmdd, "week": lambda c: week_start(c, "monday")}
        return takes[self.taken](value) if self.taken != "value" else value

    def bounds(self, low: Column | None, high: Column | None) -> list[Column]:
        """What a range of the column means for the key: conditions on partitions alone."""
        key = F.col(self.name)
        ends = [(low, key.__ge__), (high, key.__le__)]
        return [compare(self._of(end)) for end, compare in ends if end is not None]


@dataclass(frozen=True)
class TableSpec:
    """Schema, order, defaults and partition keys, from the outermost, of a stored table."""

    schema: StructType
    order: Sequence[str]
    month_of: str | None = None
    day_of: str | None = None
    defaults: dict[str, str] = field(default_factory=dict)
    more_keys: Sequence[Key] = ()

    @property
    def keys(self) -> list[Key]:
        own = [Key("ym", self.month_of, "month")] if self.month_of else []
        own += [Key("ymd", self.day_of, "day")] if self.day_of else []
        return [*own, *self.more_keys]

    @property
    def key_names(self) -> list[str]:
        return [k.name for k in self.keys]

    @property
    def stored_schema(self) -> StructType:
        added = [k.field(self.schema) for k in self.keys if k.name not in self.schema.names]
        inner = [f for f in self.schema.fields if f.name not in self.key_names]
        last = [self.schema[n] for n in self.key_names if n in self.schema.names]
        return StructType([*inner, *sorted([*added, *last], key=lambda f: self.key_names.index(f.name))])

    def with_keys(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({k.name: k.column() for k in self.keys})

    def between(self, rows: DataFrame, column: str, low=None, high=None) -> DataFrame:  # noqa: ANN001
        """Rows with ``low <= column <= high``; the range of each key of the column is added.

        Rows are the same as without these, but whole partitions are skipped.
        """
        ends = [None if x is None else F.lit(x).cast(self.schema[column].dataType) for x in (low, high)]
        value = F.col(column)
        wanted = [compare(end) for end, compare in zip(ends, (value.__ge__, value.__le__)) if end is not None]
        for k in self.keys:
            if k.of == column and k.name != column:
                wanted += k.bounds(*ends)
        for condition in wanted:
            rows = rows.where(condition)
        return rows


_TXN_ORDER = ("user_id", "created_at", "transaction_id")

TABLES: dict[str, TableSpec] = {
    "transactions": TableSpec(
        schemas.TRANSACTIONS, _TXN_ORDER, "created_at", defaults=schemas.TRANSACTION_DEFAULTS
    ),
    "transactions_by_category": TableSpec(
        schemas.TRANSACTIONS,
        _TXN_ORDER,
        "created_at",
        defaults=schemas.TRANSACTION_DEFAULTS,
        more_keys=(Key("category", "category"),),
    ),
    "payments_weekly": TableSpec(
        schemas.TRANSACTIONS,
        _TXN_ORDER,
        defaults=schemas.TRANSACTION_DEFAULTS,
        more_keys=(Key("week", "created_at", "week"), Key("status", "status")),
    ),
    "merchants": TableSpec(
        schemas.MERCHANTS, ("merchant_id",), defaults=schemas.MERCHANT_DEFAULTS
    ),
    "users": TableSpec(schemas.USERS, ("user_id",), defaults=schemas.USER_DEFAULTS),
    "events": TableSpec(
        schemas.EVENTS, ("event_date", "user_id", "event_type", "event_id"), "event_date"
    ),
    "logs_monthly": TableSpec(schemas.LOGS, ("level", "timestamp"), "timestamp"),
    "logs_daily": TableSpec(schemas.LOGS, ("level", "timestamp"), day_of="timestamp"),
    "transactions_dedup": TableSpec(
        schemas.TRANSACTION_VERSIONS,
        ("transaction_id",),
        "created_at",
        defaults={"currency": "'USD'", "updated_at": "localtimestamp()"},
    ),
    "products": TableSpec(
        schemas.PRODUCTS, ("product_id",), defaults={"updated_at": "localtimestamp()"}
    ),
    "customers_cdc": TableSpec(
        schemas.CUSTOMER_CHANGES,
        ("customer_id",),
        defaults={"is_deleted": "0", "_ts": "localtimestamp()"},
    ),
    "revenue_daily_sum": TableSpec(
        schemas.DAILY_SUMS, ("merchant_id", "metric_date"), "metric_date"
    ),
    "user_balances": TableSpec(schemas.SIGNED_BALANCES, ("user_id",)),
    "user_events": TableSpec(schemas.VERSIONED_BALANCES, ("user_id", "version")),
    "users_personal": TableSpec(
        schemas.PERSONAL_DATA, ("user_id",), defaults={"created_at": "localtimestamp()"}
    ),
    "metrics": TableSpec(
        schemas.METRICS, ("metric_name", "timestamp"), defaults={"count": "1"}
    ),
}


def create(spark: SparkSession, name: str, database: str) -> str:
    """Create one table unless it exists and return its full name."""
    spec = TABLES[name]
    full = f"{database}.{name}"
    tables.create_table(spark, full, spec.stored_schema, spec.key_names)
    return full


def create_all(spark: SparkSession, database: str) -> list[str]:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    return [create(spark, name, database) for name in TABLES]


def load(df: DataFrame, name: str, database: str, partitions: int | None = None) -> int:
    """Append rows to a table: defaults filled, sorted, counted while written."""
    spec = TABLES[name]
    rows = tables.with_defaults(df, spec.schema, spec.defaults)
    by = spec.key_names
    order = [*by, *(c for c in spec.order if c not in by)]
    placed = tables.clustered(spec.with_keys(rows), order, partitions)
    return tables.append(placed, f"{database}.{name}", by)
