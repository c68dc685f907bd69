"""Table schemas and result schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)
MONEY_TOTAL = DecimalType(38, 2)


def _schema(*fields) -> StructType:
    """Fields as (name, type) or (name, type, nullable); NOT NULL by default."""
    return StructType(
        [StructField(f[0], f[1], f[2] if len(f) > 2 else False) for f in fields]
    )


TRANSACTIONS = _schema(
    ("transaction_id", StringType()),
    ("user_id", LongType()),
    ("merchant_id", LongType()),
    ("amount", MONEY),
    ("currency", StringType()),
    ("status", StringType()),
    ("category", StringType()),
    ("payment_method", StringType()),
    ("created_at", TimestampNTZType()),
    ("processed_at", TimestampNTZType(), True),
    ("metadata", MapType(StringType(), StringType())),
)

MERCHANTS = _schema(
    ("merchant_id", LongType()),
    ("name", StringType()),
    ("category", StringType()),
    ("country_code", StringType()),
    ("city", StringType()),
    ("mcc", IntegerType()),
    ("is_active", ShortType()),
    ("monthly_volume", MONEY),
    ("created_at", TimestampNTZType()),
    ("updated_at", TimestampNTZType()),
)

USERS = _schema(
    ("user_id", LongType()),
    ("email", StringType()),
    ("username", StringType()),
    ("country_code", StringType()),
    ("tier", StringType()),
    ("is_verified", ShortType()),
    ("is_active", ShortType()),
    ("created_at", TimestampNTZType()),
    ("last_login_at", TimestampNTZType(), True),
)

TRANSACTION_VERSIONS = _schema(
    ("transaction_id", StringType()),
    ("user_id", LongType()),
    ("merchant_id", LongType()),
    ("amount", MONEY),
    ("currency", StringType()),
    ("status", StringType()),
    ("category", StringType()),
    ("created_at", TimestampNTZType()),
    ("updated_at", TimestampNTZType()),
)

PRODUCTS = _schema(
    ("product_id", LongType()),
    ("name", StringType()),
    ("price", DecimalType(10, 2)),
    ("stock_quantity", LongType()),
    ("updated_at", TimestampNTZType()),
)

CUSTOMER_CHANGES = _schema(
    ("customer_id", LongType()),
    ("email", StringType()),
    ("name", StringType()),
    ("is_deleted", ShortType()),
    ("_version", LongType()),
    ("_ts", TimestampNTZType()),
)

DAILY_SUMS = _schema(
    ("merchant_id", LongType()),
    ("metric_date", DateType()),
    ("total_amount", MONEY),
    ("transaction_count", LongType()),
)

SIGNED_BALANCES = _schema(
    ("user_id", LongType()),
    ("balance", MONEY),
    ("sign", ByteType()),
)

VERSIONED_BALANCES = _schema(
    ("user_id", LongType()),
    ("balance", MONEY),
    ("sign", ByteType()),
    ("version", LongType()),
)

EVENTS = _schema(
    ("event_date", DateType()),
    ("event_time", TimestampNTZType()),
    ("event_id", StringType()),
    ("user_id", LongType()),
    ("event_type", StringType()),
    ("properties", StringType()),
)

METRICS = _schema(
    ("metric_name", StringType()),
    ("timestamp", TimestampNTZType()),
    ("value", DoubleType()),
    ("count", LongType()),
)

LOGS = _schema(
    ("timestamp", TimestampNTZType()),
    ("level", StringType()),
    ("message", StringType()),
)

PERSONAL_DATA = _schema(
    ("user_id", LongType()),
    ("email", StringType(), True),
    ("phone", StringType(), True),
    ("username", StringType()),
    ("country", StringType()),
    ("created_at", TimestampNTZType()),
)

# Result schemas.
PAYMENT_METRIC = _schema(
    ("merchant_id", LongType()),
    ("category", StringType()),
    ("currency", StringType()),
    ("metric_date", DateType()),
    ("total_amount", MONEY_TOTAL),
    ("transaction_count", LongType()),
    ("avg_amount", DoubleType()),
    ("min_amount", MONEY),
    ("max_amount", MONEY),
    ("unique_users", LongType()),
)

# Column defaults as SQL expressions, filled in when a row leaves them out.
TRANSACTION_DEFAULTS = {
    "transaction_id": "uuid()",
    "currency": "'USD'",
    "status": "'pending'",
    "payment_method": "'card'",
    "created_at": "localtimestamp()",
    "metadata": "cast(map() as map<string,string>)",
}
MERCHANT_DEFAULTS = {
    "is_active": "1",
    "monthly_volume": "0",
    "created_at": "localtimestamp()",
    "updated_at": "localtimestamp()",
}
USER_DEFAULTS = {
    "tier": "'standard'",
    "is_verified": "0",
    "is_active": "1",
    "created_at": "localtimestamp()",
}

# Domains a transaction may use.
# Categories with their amount range (low, high).
CATEGORY_AMOUNTS = {
    "retail": (5, 500),
    "groceries": (10, 300),
    "restaurants": (15, 150),
    "travel": (50, 2000),
    "entertainment": (10, 200),
    "utilities": (50, 500),
    "healthcare": (20, 1000),
    "education": (100, 5000),
    "subscriptions": (5, 100),
    "transportation": (5, 200),
}
# Currencies and payment methods.
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD", "JPY"]
PAYMENT_METHODS = ["card", "bank_transfer", "wallet", "crypto"]
# Share of each status in generated rows, in percent.
STATUS_WEIGHTS = {
    "pending": 5,
    "processing": 3,
    "completed": 80,
    "failed": 5,
    "refunded": 4,
    "cancelled": 3,
}
