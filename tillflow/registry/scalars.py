"""Scalar functions and insert-time rules, applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillflow.functions import enums, money, times
from tillflow.registry import Registry
from tillflow.registry.analytics import AS_OF, MERCHANT_ID, USER_ID
from tillflow.registry.sql_views import HIST, TXN, select
from tillflow.sources import views
from tillflow.sources.generator import Generator, size_estimate, with_batch_id
from tillflow.sources.schemas import TRANSACTION_DEFAULTS, TRANSACTIONS
from tillflow.sources.tables import with_defaults

REGISTRY = Registry()
query = REGISTRY.add


@query(
    "partition_keys",
    select(
        """SELECT transaction_id, user_id, amount,
          CAST(year(created_at) * 100 + month(created_at) AS INTEGER) AS ym,
          CAST(year(created_at) * 10000 + month(created_at) * 100 + day(created_at) AS INTEGER)
            AS ymd,
          CAST(date_trunc('week', created_at) AS DATE) AS week,
          status AS sub_partition
        FROM hist""",
        HIST,
    ),
)
def _(spark, d):
    return views.txn_hist(spark, d).select(
        "transaction_id",
        "user_id",
        "amount",
        times.yyyymm("created_at").alias("ym"),
        times.yyyymmdd("created_at").alias("ymd"),
        times.week_start("created_at", "monday").alias("week"),
        F.col("status").alias("sub_partition"),
    )


@query(
    "date_parts",
    select(
        """SELECT transaction_id, CAST(created_at AS DATE) AS day,
          CAST(hour(created_at) AS INTEGER) AS hour_of_day,
          date_trunc('hour', created_at) AS hour_start,
          CAST(date_trunc('month', created_at) AS DATE) AS month_start,
          CAST(isodow(created_at) AS INTEGER) AS day_of_week,
          CASE WHEN isodow(created_at) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
          CAST(created_at AS DATE) - CAST(dayofweek(created_at) AS INTEGER) AS week_sunday
        FROM txn""",
        TXN,
    ),
)
def _(spark, d):
    at = "created_at"
    return views.txn(spark, d).select(
        "transaction_id",
        times.day(at).alias("day"),
        times.hour_of_day(at).alias("hour_of_day"),
        times.hour_start(at).alias("hour_start"),
        times.month_start(at).alias("month_start"),
        times.iso_weekday(at).alias("day_of_week"),
        times.is_weekend(at).alias("is_weekend"),
        times.week_start(at).alias("week_sunday"),
    )


@query(
    "date_diffs",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
      CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS days,
      CAST(date_diff('month', o_orderdate, l_shipdate) AS INTEGER) AS months
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, d):
    line, orders = (views.table(spark, d, t) for t in ("lineitem", "orders"))
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        times.days_between("o_orderdate", "l_shipdate").alias("days"),
        times.months_between_grid("o_orderdate", "l_shipdate").alias("months"),
    )


@query(
    "date_arith",
    """SELECT o_orderkey, o_orderdate + INTERVAL 30 DAY AS plus_30_days,
      o_orderdate + INTERVAL 6 MONTH AS plus_6_months,
      o_orderdate + INTERVAL 1 YEAR AS plus_1_year,
      o_orderdate + INTERVAL 1 SECOND AS plus_1_second,
      CAST(o_orderdate AS DATE) - 30 AS minus_30
    FROM orders""",
)
def _(spark, d):
    at = "o_orderdate"
    return views.table(spark, d, "orders").select(
        "o_orderkey",
        times.plus(at, days=30).alias("plus_30_days"),
        times.plus(at, months=6).alias("plus_6_months"),
        times.plus(at, years=1).alias("plus_1_year"),
        times.plus(at, seconds=1).alias("plus_1_second"),
        F.date_sub(times.day(at), 30).alias("minus_30"),
    )


_SIZES = ["B", "KiB", "MiB", "GiB", "TiB", "PiB"]
_SIZE_CASES = " ".join(
    f"WHEN n >= {1024**p}::DOUBLE THEN printf('%.2f {u}', round(n / {1024**p}::DOUBLE, 2))"
    for p, u in reversed(list(enumerate(_SIZES)))
    if p
)


@query(
    "readable_size",
    f"""SELECT o_orderkey, CASE {_SIZE_CASES} ELSE printf('%.2f B', n) END AS size FROM (
      SELECT o_orderkey, CAST(o_orderkey * o_orderkey * o_custkey AS DOUBLE) AS n FROM orders)""",
)
def _(spark, d):
    size = money.product("o_orderkey", "o_orderkey", "o_custkey")
    sized = views.table(spark, d, "orders").select("o_orderkey", size.alias("size"))
    return sized.select("o_orderkey", money.readable_size("size").alias("size"))


@query(
    "nested_access",
    select(
        """SELECT transaction_id, (category = 'error' OR currency = 'error') AS has_error,
          category AS first_tag, amount AS location_amount, currency AS source,
          CAST(NULL AS VARCHAR) AS absent
        FROM txn""",
        TXN,
    ),
)
def _(spark, d):
    nested = views.txn(spark, d).select(
        "transaction_id",
        F.array("category", "currency").alias("tags"),
        F.struct("user_id", "amount").alias("location"),
        F.create_map(F.lit("source"), F.col("currency")).alias("metadata"),
    )
    return nested.select(
        "transaction_id",
        F.array_contains("tags", "error").alias("has_error"),
        F.element_at("tags", 1).alias("first_tag"),
        F.col("location.amount").alias("location_amount"),
        F.col("metadata")["source"].alias("source"),
        F.col("metadata")["absent"].alias("absent"),
    )


@query(
    "to_decimal_safe",
    """SELECT o_orderkey, coalesce(try_cast(raw AS DECIMAL(18,2)), 0.00) AS amount FROM (
      SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_totalprice AS VARCHAR)
        WHEN 'O' THEN o_orderpriority END AS raw FROM orders)""",
)
def _(spark, d):
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).when(
        status == "O", F.col("o_orderpriority")
    )
    return views.table(spark, d, "orders").select(
        "o_orderkey", money.parse_amount(raw).alias("amount")
    )


@query(
    "report_format",
    select(
        """SELECT transaction_id,
          '$' || format('{:,.2f}', CAST(amount * 1000 AS DOUBLE)) AS dollars,
          format('{:,}', transaction_id * 1000) AS grouped,
          upper(status) AS status_text,
          strftime(created_at, '%Y-%m-%d %H:%M:%S') AS at_text,
          strftime(created_at, '%Y-%m-%d %H:00') AS hour_text,
          format('{:.1f}', CAST(transaction_id % 1000 AS DOUBLE) / 8.0) || '%' AS pct_text
        FROM txn""",
        TXN,
    ),
)
def _(spark, d):
    eighth = (F.col("transaction_id") % 1000).cast("double") / F.lit(8.0)
    return views.txn(spark, d).select(
        "transaction_id",
        money.dollars(F.col("amount") * 1000).alias("dollars"),
        money.grouped(F.col("transaction_id") * 1000).alias("grouped"),
        F.upper("status").alias("status_text"),
        times.to_text("created_at").alias("at_text"),
        times.hour_text("created_at").alias("hour_text"),
        money.percent_text(eighth).alias("pct_text"),
    )


@query(
    "enum_validate",
    select(
        """SELECT transaction_id, raw, CASE raw WHEN '1' THEN 'pending' WHEN '2' THEN 'processing'
            WHEN '3' THEN 'completed' WHEN '4' THEN 'failed' WHEN '5' THEN 'refunded'
            WHEN '6' THEN 'cancelled' ELSE
            CASE WHEN lower(raw) IN ('pending', 'processing', 'completed', 'failed', 'refunded',
              'cancelled') THEN lower(raw) END END AS status,
          CASE lower(raw) WHEN 'pending' THEN 1 WHEN 'processing' THEN 2 WHEN 'completed' THEN 3
            WHEN 'failed' THEN 4 WHEN 'refunded' THEN 5 WHEN 'cancelled' THEN 6 END AS code
        FROM (SELECT transaction_id, CASE transaction_id % 3
            WHEN 0 THEN CAST(merchant_id % 8 AS VARCHAR) WHEN 1 THEN upper(status)
            ELSE category END AS raw FROM txn)""",
        TXN,
    ),
)
def _(spark, d):
    kind = F.col("transaction_id") % 3
    raw = (
        F.when(kind == 0, (F.col("merchant_id") % 8).cast("string"))
        .when(kind == 1, F.upper("status"))
        .otherwise(F.col("category"))
    )
    return (
        views.txn(spark, d)
        .select("transaction_id", raw.alias("raw"))
        .select(
            "transaction_id",
            "raw",
            enums.coerce("raw").alias("status"),
            enums.code_of("raw").alias("code"),
        )
    )


@query(
    "apply_defaults",
    select(
        """SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, user_id, merchant_id, amount,
          CASE WHEN currency = 'JPY' THEN 'USD' ELSE currency END AS currency,
          'pending' AS status, category,
          CASE WHEN payment_method = 'crypto' THEN 'card' ELSE payment_method END
            AS payment_method,
          created_at, CAST(NULL AS TIMESTAMP) AS processed_at, 0 AS metadata_entries
        FROM txn""",
        TXN,
    ),
)
def _(spark, d):
    partial = views.txn(spark, d).select(
        "transaction_id",
        "user_id",
        "merchant_id",
        "amount",
        F.when(F.col("currency") != "JPY", F.col("currency")).alias("currency"),
        "category",
        F.when(F.col("payment_method") != "crypto", F.col("payment_method")).alias(
            "payment_method"
        ),
        "created_at",
    )
    full = with_defaults(partial, TRANSACTIONS, TRANSACTION_DEFAULTS)
    return full.withColumn("metadata_entries", F.size("metadata")).drop("metadata")


# -- generated rows ---------------------------------------------------------


def _event_ids(spark, d):
    return views.table(spark, d, "events").select(F.col("event_id").alias("id"))


def _generator(days: int = 90) -> Generator:
    return Generator(users=10_000, merchants=1_000, days=days, seed=42, as_of=AS_OF)


@query("gen_transactions")
def _(spark, d):
    return _generator().from_ids(_event_ids(spark, d))


@query("gen_user")
def _(spark, d):
    return _generator().from_ids(_event_ids(spark, d), user_id=USER_ID)


@query("gen_merchant")
def _(spark, d):
    return _generator().from_ids(_event_ids(spark, d), merchant_id=MERCHANT_ID)


@query(
    "gen_batches",
    "SELECT event_id // 700 AS batch_id, count(*) AS rows FROM events GROUP BY 1",
)
def _(spark, d):
    ids = with_batch_id(_event_ids(spark, d), "id", 700)
    made = _generator().from_ids(ids, keep=["batch_id"])
    return made.groupBy("batch_id").agg(F.count("*").alias("rows"))


@query(
    "row_counts",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("customer", "events", "lineitem", "nation", "orders", "part", "supplier")
    ),
)
def _(spark, d):
    names = ("customer", "events", "lineitem", "nation", "orders", "part", "supplier")
    counts = [
        views.table(spark, d, t)
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(t).alias("table_name"), "row_count")
        for t in names
    ]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


@query(
    "size_estimate",
    """SELECT n AS row_count, n * 120 AS estimated_uncompressed_bytes,
      round(n * 120 / 1048576.0::DOUBLE, 2) AS estimated_uncompressed_mb,
      n * 120 / 10.0::DOUBLE AS estimated_compressed_bytes_low,
      n * 120 / 5.0::DOUBLE AS estimated_compressed_bytes_high,
      round(n * 120 / 10.0::DOUBLE / 1048576.0::DOUBLE, 2) AS estimated_compressed_mb_low,
      round(n * 120 / 5.0::DOUBLE / 1048576.0::DOUBLE, 2) AS estimated_compressed_mb_high
    FROM (SELECT count(*) AS n FROM lineitem)""",
)
def _(spark, d):
    counts = views.table(spark, d, "lineitem").agg(F.count("*").alias("row_count"))
    return size_estimate(counts)
