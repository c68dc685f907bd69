"""States, merge semantics and maintained views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.clock import last_days, last_hours_rolling, moment
from tillflow.functions import times
from tillflow.operators import merges
from tillflow.operators.joins import enrich
from tillflow.operators.states import PART_COLUMNS, Measure, exact_quantile_of, read_states
from tillflow.plans import customers
from tillflow.registry import Registry
from tillflow.registry.analytics import AS_OF, MERCHANT_ID
from tillflow.registry.sql_views import (
    CHANGES,
    LINE_VERSIONS,
    MERCHANTS,
    SIGNED,
    TXN,
    VERSIONS,
    mean,
    select,
    total,
)
from tillflow.session import shared_dir
from tillflow.sources import copies, views
from tillflow.sources.schemas import PAYMENT_METRIC
from tillflow.streaming import hours, pipelines
from tillflow.streaming import views as maintained

REGISTRY = Registry()
query = REGISTRY.add

AMOUNT, COUNT = total("amount"), "count(*)"
BACKFILL_CUT = datetime(2024, 1, 15)


# -- aggregate states -------------------------------------------------------


def _states(spark, d, view) -> DataFrame:
    """What a view has stored, with the states of files that came since the last use added."""

    def add(paths: list[str], folder: str) -> None:
        events = spark.read.schema(views.SCHEMAS["events"]).parquet(*paths)
        save(view.delta(views.as_transactions(events)), folder)

    def merge(folders: list[str], folder: str) -> None:
        save(view.merge(copies.stored(spark, folders)), folder)

    def save(states: DataFrame, folder: str) -> None:
        states.withColumn("ym", times.yyyymm(view.month_of)).write.partitionBy("ym").parquet(folder)

    return copies.copy_of(spark, f"{d}/events.parquet", f"view-{view.name}", add, merge)


def _metric_states(spark, d, sketches: bool = False) -> DataFrame:
    return _states(spark, d, maintained.payment_metrics(sketches))


@query(
    "metrics_state_build",
    select(
        f"""SELECT merchant_id, category, currency, CAST(created_at AS DATE) AS metric_date,
          {AMOUNT} AS total_amount, {COUNT} AS transaction_count, {AMOUNT} AS avg_amount_sum,
          {COUNT} AS avg_amount_count, min(amount) AS min_amount, max(amount) AS max_amount
        FROM txn GROUP BY 1, 2, 3, 4""",
        TXN,
    ),
)
def _(spark, d):
    states = maintained.payment_metrics().delta(views.txn(spark, d))
    return states.where("_part IS NULL").drop("amount_kll", *PART_COLUMNS)


_SKETCHED = ("unique_customers", "median_transaction", "p99_transaction")
_PLAIN = ("total_amount", "transaction_count", "avg_amount", "min_amount", "max_amount")


@query(
    "state_merge_merchant",
    select(
        f"""SELECT merchant_id, {AMOUNT} AS revenue, {COUNT} AS txn_count,
          {mean('amount')} AS avg_txn_amount
        FROM txn GROUP BY merchant_id ORDER BY revenue DESC, merchant_id LIMIT 10""",
        TXN,
    ),
)
def _(spark, d):
    view = maintained.payment_metrics()
    wanted = [m for m in view.measures if m.name in ("total_amount", "transaction_count", "avg_amount")]
    merged = read_states(_metric_states(spark, d), ["merchant_id"], wanted)
    return (
        merged.select(
            "merchant_id",
            F.col("total_amount").alias("revenue"),
            F.col("transaction_count").alias("txn_count"),
            F.col("avg_amount").alias("avg_txn_amount"),
        )
        .orderBy(F.desc("revenue"), "merchant_id")
        .limit(10)
    )


@query(
    "state_merge_daily",
    select(
        f"""SELECT CAST(created_at AS DATE) AS metric_date, {AMOUNT} AS revenue,
          {COUNT} AS txn_count, count(DISTINCT user_id) AS unique_customers,
          quantile_disc(CAST(amount AS DOUBLE), 0.5) AS median_amount
        FROM txn WHERE merchant_id = {MERCHANT_ID} GROUP BY 1""",
        TXN,
    ),
)
def _(spark, d):
    view = maintained.payment_metrics()
    names = ("total_amount", "transaction_count", "unique_users", "amount_p50")
    wanted = [m for m in view.measures if m.name in names]
    states = _metric_states(spark, d).where(F.col("merchant_id") == MERCHANT_ID)
    return (
        read_states(states, ["metric_date"], wanted)
        .select(
            "metric_date",
            F.col("total_amount").alias("revenue"),
            F.col("transaction_count").alias("txn_count"),
            F.col("unique_users").alias("unique_customers"),
            F.col("amount_p50").alias("median_amount"),
        )
        .orderBy("metric_date")
    )


def _full_statistics(states: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """What some measures of the metric states hold, per merchant and category."""
    merged = read_states(states, ["merchant_id", "category"], measures)
    sketched = dict(zip(_SKETCHED, ("unique_users", "amount_p50", "amount_p99")))
    return merged.select(
        "merchant_id",
        "category",
        F.col("total_amount").alias("total_revenue"),
        F.col("avg_amount").alias("average_transaction"),
        F.col("min_amount").alias("smallest_transaction"),
        F.col("max_amount").alias("largest_transaction"),
        F.col("transaction_count").alias("total_transactions"),
        *[F.col(c).alias(name) for name, c in sketched.items() if c in merged.columns],
        F.try_divide(
            F.col("total_amount").cast("double"), F.col("transaction_count").cast("double")
        ).alias("calculated_avg"),
    ).orderBy(F.desc("total_revenue"), "merchant_id", "category")


@query(
    "state_merge_full",
    select(
        f"""SELECT merchant_id, category, {AMOUNT} AS total_revenue,
          {mean('amount')} AS average_transaction, min(amount) AS smallest_transaction,
          max(amount) AS largest_transaction, {COUNT} AS total_transactions,
          {mean('amount')} AS calculated_avg
        FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' GROUP BY merchant_id, category""",
        TXN,
    ),
)
def _(spark, d):
    recent = last_days(_metric_states(spark, d), 30, AS_OF, ts="metric_date")
    plain = [m for m in maintained.payment_metrics().measures if m.name in _PLAIN]
    return _full_statistics(recent, plain)


@query("state_merge_full_sketches")
def _(spark, d):
    """The same with users and percentiles as sketches, which are estimates in large groups."""
    states = last_days(_metric_states(spark, d, sketches=True), 30, AS_OF, ts="metric_date")
    return _full_statistics(states, maintained.payment_metrics(sketches=True).measures)


@query(
    "payment_metrics_result",
    select(
        f"""SELECT merchant_id, category, currency, CAST(created_at AS DATE) AS metric_date,
          {AMOUNT} AS total_amount, {COUNT} AS transaction_count, {mean('amount')} AS avg_amount,
          min(amount) AS min_amount, max(amount) AS max_amount,
          count(DISTINCT user_id) AS unique_users
        FROM txn GROUP BY 1, 2, 3, 4""",
        TXN,
    ),
)
def _(spark, d):
    """The typed result row of the metric states."""
    result = maintained.payment_metrics().read(_metric_states(spark, d))
    return result.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PAYMENT_METRIC.fields]
    )


@query(
    "uniq_state_merge",
    select(
        """SELECT category, count(DISTINCT merchant_id) AS unique_merchants,
          count(DISTINCT user_id) AS unique_users FROM txn GROUP BY category""",
        TXN,
    ),
)
def _(spark, d):
    """Merchants and users per category, merged from daily bitmaps per status; exact."""
    view = maintained.category_stats()
    counts = [m for m in view.measures if m.name.startswith("unique_")]
    return read_states(_states(spark, d, view), ["category"], counts)


@query(
    "quantile_state_merge",
    select(
        """SELECT category, quantile_disc(CAST(amount AS DOUBLE), 0.5) AS p50,
          quantile_disc(CAST(amount AS DOUBLE), 0.95) AS p95,
          quantile_disc(CAST(amount AS DOUBLE), 0.99) AS p99
        FROM txn GROUP BY category""",
        TXN,
    ),
)
def _(spark, d):
    """Quantiles per category from daily counts of amounts per status; exact."""
    wanted = [exact_quantile_of(f"p{int(p * 100)}", p) for p in (0.5, 0.95, 0.99)]
    return read_states(_states(spark, d, maintained.category_stats()), ["category"], wanted)


@query(
    "topk_state_merge",
    select(
        """SELECT user_id, category AS favorite_category, n AS favorite_count,
          CAST(0 AS BIGINT) AS count_error
        FROM (SELECT user_id, category, count(*) AS n FROM txn GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) = 1""",
        TXN,
    ),
)
def _(spark, d):
    """Favourite category of each user from weekly top-k states."""
    view = maintained.user_favorites()
    read = read_states(_states(spark, d, view), ["user_id"], view.measures)
    return read.select(
        "user_id",
        F.col("favorite.value").alias("favorite_category"),
        F.col("favorite.count").alias("favorite_count"),
        F.col("favorite.error").alias("count_error"),
    )


@query(
    "aggregating_final",
    select(
        f"""SELECT merchant_id, category, currency, {AMOUNT} AS total_amount,
          {COUNT} AS transaction_count, {mean('amount')} AS avg_amount,
          min(amount) AS min_amount, max(amount) AS max_amount
        FROM txn GROUP BY 1, 2, 3""",
        TXN,
    ),
)
def _(spark, d):
    view = maintained.payment_metrics()
    plain = [m for m in view.measures if m.name in _PLAIN]
    return read_states(_metric_states(spark, d), ["merchant_id", "category", "currency"], plain)


# -- latest versions --------------------------------------------------------


@query(
    "replacing_final",
    select(
        """SELECT * FROM versions QUALIFY row_number() OVER (
          PARTITION BY transaction_id ORDER BY updated_at DESC, sequence DESC) = 1""",
        TXN,
        VERSIONS,
    ),
)
def _(spark, d):
    return merges.latest_version(
        views.txn_versions(spark, d), ["transaction_id"], "updated_at", ["sequence"]
    )


@query(
    "replacing_last_insert",
    select(
        """SELECT * FROM versions QUALIFY row_number() OVER (
          PARTITION BY transaction_id ORDER BY sequence DESC) = 1""",
        TXN,
        VERSIONS,
    ),
)
def _(spark, d):
    return merges.last_insert(views.txn_versions(spark, d), ["transaction_id"], "sequence")


@query(
    "replacing_multi_key",
    select(
        """SELECT * FROM versions QUALIFY row_number() OVER (
          PARTITION BY user_id, category ORDER BY updated_at DESC, sequence DESC) = 1""",
        TXN,
        VERSIONS,
    ),
)
def _(spark, d):
    return merges.latest_version(
        views.txn_versions(spark, d), ["user_id", "category"], "updated_at", ["sequence"]
    )


_LINE_ORDER = """version DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, amount DESC"""
_LINE_TIES = ["l_linenumber", "l_partkey", "l_suppkey", "amount"]


@query(
    "replacing_partition_scope",
    select(
        f"""SELECT * FROM line_versions QUALIFY row_number() OVER (
          PARTITION BY order_id, ym ORDER BY {_LINE_ORDER}) = 1""",
        LINE_VERSIONS,
    ),
)
def _(spark, d):
    return merges.latest_version(
        views.line_versions(spark, d), ["order_id"], "version", _LINE_TIES, scope=["ym"]
    )


@query(
    "replacing_lines",
    select(
        f"""SELECT * FROM line_versions QUALIFY row_number() OVER (
          PARTITION BY order_id ORDER BY {_LINE_ORDER}) = 1""",
        LINE_VERSIONS,
    ),
)
def _(spark, d):
    return merges.latest_version(
        views.line_versions(spark, d), ["order_id"], "version", _LINE_TIES
    )


@query(
    "dedup_user_total",
    select(
        """SELECT user_id, CAST(sum(amount) AS DECIMAL(38,2)) AS total FROM (
          SELECT * FROM versions QUALIFY row_number() OVER (
            PARTITION BY transaction_id ORDER BY updated_at DESC, sequence DESC) = 1)
        WHERE status = 'completed' GROUP BY user_id""",
        TXN,
        VERSIONS,
    ),
)
def _(spark, d):
    newest = merges.latest_version(
        views.txn_versions(spark, d), ["transaction_id"], "updated_at", ["sequence"]
    )
    return customers.spend_of(newest.where(F.col("status") == "completed"))


@query(
    "cdc_current_state",
    select(
        """SELECT * FROM (SELECT * FROM changes QUALIFY row_number() OVER (
          PARTITION BY customer_id ORDER BY _version DESC) = 1) WHERE is_deleted = 0""",
        CHANGES,
    ),
)
def _(spark, d):
    return merges.current_state(views.changes(spark, d), ["customer_id"], "_version")


_PRODUCT_ROWS = """products AS (
  SELECT p_partkey AS product_id, p_name AS name, CAST(p_retailprice AS DECIMAL(18,2)) AS price,
    TIMESTAMP '1990-01-01' AS updated_at, CAST(0 AS BIGINT) AS sequence FROM part
  UNION ALL SELECT l_partkey, p_name || ' Pro',
    CAST(l_extendedprice AS DECIMAL(18,2)), l_shipdate, l_orderkey * 10 + l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(
    "product_upsert",
    select(
        """SELECT product_id, max(name) AS name, max(price) AS price, max(updated_at) AS updated_at
        FROM (SELECT *, rank() OVER (PARTITION BY product_id
          ORDER BY updated_at DESC, sequence DESC, price DESC) AS r FROM products)
        WHERE r = 1 GROUP BY product_id""",
        _PRODUCT_ROWS,
    ),
)
def _(spark, d):
    """List prices, re-inserted with every sale; the newest insert is current.

    Versions are reduced to one row per product before names are joined.
    """
    part, line = views.table(spark, d, "part"), views.table(spark, d, "lineitem")
    listed = part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        moment(datetime(1990, 1, 1)).alias("updated_at"),
        F.lit(0).cast("long").alias("sequence"),
    )
    sold = line.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_shipdate").alias("updated_at"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sequence"),
    )
    current = merges.latest_version(
        listed.unionByName(sold), ["product_id"], "updated_at", ["sequence", "price"]
    )
    names = part.select(F.col("p_partkey").alias("product_id"), "p_name")
    was_sold = F.col("sequence") > 0
    name = F.when(was_sold, F.concat("p_name", F.lit(" Pro"))).otherwise(F.col("p_name"))
    return current.join(names, "product_id").select(
        "product_id", name.alias("name"), "price", "updated_at"
    )


@query(
    "raw_versions",
    select(
        f"""SELECT transaction_id, {COUNT} AS stored_rows, {AMOUNT} AS stored_amount
        FROM versions GROUP BY transaction_id""",
        TXN,
        VERSIONS,
    ),
)
def _(spark, d):
    """What a reader sees before any merge: every stored version counts."""
    return (
        views.txn_versions(spark, d)
        .groupBy("transaction_id")
        .agg(
            F.count("*").alias("stored_rows"),
            F.sum("amount").cast("decimal(38,2)").alias("stored_amount"),
        )
    )


# -- sums and cancellation --------------------------------------------------


@query(
    "summing_final",
    select(
        f"""SELECT merchant_id, CAST(created_at AS DATE) AS metric_date,
          {AMOUNT} AS total_amount, {COUNT} AS transaction_count FROM txn GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    inserted = views.txn(spark, d).select(
        "merchant_id",
        times.day("created_at").alias("metric_date"),
        F.col("amount").alias("total_amount"),
        F.lit(1).cast("long").alias("transaction_count"),
    )
    merged = merges.summing(inserted, ["merchant_id", "metric_date"])
    return merged.withColumn("total_amount", F.col("total_amount").cast("decimal(38,2)"))


@query(
    "collapsing_final",
    select(
        """SELECT key, balance, 1 AS sign FROM signed
        GROUP BY key, balance HAVING sum(sign) > 0""",
        SIGNED,
    ),
)
def _(spark, d):
    return merges.collapse(views.signed_rows(spark, d).drop("version"))


@query(
    "versioned_collapsing_final",
    select(
        """SELECT key, balance, version, 1 AS sign FROM signed
        GROUP BY key, balance, version HAVING sum(sign) > 0""",
        SIGNED,
    ),
)
def _(spark, d):
    return merges.collapse(views.signed_rows(spark, d))


@query(
    "unmatched_cancels",
    select(
        """SELECT key, balance, version, CAST(-sum(sign) AS BIGINT) AS missing FROM signed
        WHERE NOT (sign = 1 AND version = 1)
        GROUP BY key, balance, version HAVING sum(sign) < 0""",
        SIGNED,
    ),
)
def _(spark, d):
    """Cancels left alone when the first entries have not arrived yet."""
    late = views.signed_rows(spark, d).where(~((F.col("sign") == 1) & (F.col("version") == 1)))
    return merges.unmatched_cancels(late)


# -- maintained views -------------------------------------------------------


_DOW = "isodow(created_at)"
_ENRICHED = f"""SELECT transaction_id, user_id, merchant_id, amount,
  CASE currency WHEN 'EUR' THEN CAST(amount * CAST(1.08 AS DECIMAL(10,4)) AS DECIMAL(18,2))
    WHEN 'GBP' THEN CAST(amount * CAST(1.27 AS DECIMAL(10,4)) AS DECIMAL(18,2))
    ELSE amount END AS amount_usd,
  status, category, CAST(hour(created_at) AS INTEGER) AS hour_of_day,
  CAST({_DOW} AS INTEGER) AS day_of_week,
  CASE WHEN {_DOW} >= 6 THEN 1 ELSE 0 END AS is_weekend, created_at FROM txn"""


@query("mv_transactions_enriched", select(_ENRICHED, TXN))
def _(spark, d):
    return maintained.enriched().delta(views.txn(spark, d))


_HOURLY = f"""SELECT merchant_id, category, date_trunc('hour', created_at) AS hour,
  {AMOUNT} AS total_amount, {COUNT} AS transaction_count,
  count(DISTINCT user_id) AS unique_users, {mean('amount')} AS avg_amount
  FROM txn"""


@query("mv_hourly_revenue", select(f"{_HOURLY} GROUP BY 1, 2, 3", TXN))
def _(spark, d):
    view = maintained.hourly_revenue()
    return view.read(view.delta(views.txn(spark, d)))


@query(
    "hourly_revenue_read",
    select(
        f"""SELECT merchant_id, category, hour, total_amount AS revenue,
          transaction_count AS txn_count, unique_users AS unique_customers,
          avg_amount AS avg_transaction
        FROM ({_HOURLY} GROUP BY 1, 2, 3) WHERE hour >= TIMESTAMP '2024-01-24'""",
        TXN,
    ),
)
def _(spark, d):
    view = maintained.hourly_revenue()
    states = last_hours_rolling(_states(spark, d, view), 7, AS_OF, ts="hour")
    return (
        view.read(states)
        .select(
            "merchant_id",
            "category",
            "hour",
            F.col("total_amount").alias("revenue"),
            F.col("transaction_count").alias("txn_count"),
            F.col("unique_users").alias("unique_customers"),
            F.col("avg_amount").alias("avg_transaction"),
        )
        .orderBy(F.desc("hour"), "merchant_id", "category")
    )


_SPENDING = f"""SELECT user_id, CAST(created_at AS DATE) AS spending_date, currency,
  {AMOUNT} AS total_spent, {COUNT} AS transaction_count FROM txn
  WHERE status IN ('completed', 'processing') GROUP BY 1, 2, 3"""


@query("mv_user_spending", select(_SPENDING, TXN))
def _(spark, d):
    view = maintained.user_spending()
    return view.read(view.delta(views.txn(spark, d)))


@query(
    "user_spending_daily",
    select(
        f"""SELECT user_id, spending_date,
          CAST(sum(total_spent) AS DECIMAL(38,2)) AS daily_total,
          CAST(sum(transaction_count) AS BIGINT) AS daily_txns
        FROM ({_SPENDING}) GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    view = maintained.user_spending()
    merged = view.roll_up(view.delta(views.txn(spark, d)), ["user_id", "spending_date"])
    return merged.select(
        "user_id",
        "spending_date",
        F.col("total_spent").alias("daily_total"),
        F.col("transaction_count").alias("daily_txns"),
    )


_CATEGORY_STATS = f"""SELECT category, status, CAST(created_at AS DATE) AS stat_date,
  {AMOUNT} AS total_amount, {COUNT} AS transaction_count,
  count(DISTINCT merchant_id) AS unique_merchants, count(DISTINCT user_id) AS unique_users,
  quantile_disc(CAST(amount AS DOUBLE), 0.5) AS median_amount,
  quantile_disc(CAST(amount AS DOUBLE), 0.95) AS p95_amount
  FROM txn GROUP BY 1, 2, 3"""


@query("mv_category_stats", select(_CATEGORY_STATS, TXN))
def _(spark, d):
    view = maintained.category_stats()
    return view.read(view.delta(views.txn(spark, d)))


@query("mv_backfill", select(f"{_HOURLY} GROUP BY 1, 2, 3", TXN))
def _(spark, d):
    """History filled in batch, later rows as a delta: together the whole stored view."""
    txn = views.txn(spark, d)
    view, root = maintained.hourly_revenue(), shared_dir(spark, "backfill")
    old = F.coalesce(F.col("created_at") < moment(BACKFILL_CUT), F.lit(False))
    pipelines.write_delta(view, txn.where(old), root, 0)
    pipelines.write_delta(view, txn.where(~old), root, 0, "live")
    return view.read(pipelines.stored(spark, view, root))


def _chained(level: str) -> str:
    return select(
        f"""SELECT merchant_id, category, CAST(date_trunc('{level}', created_at) AS DATE) AS {level},
          {AMOUNT} AS total_amount, {COUNT} AS transaction_count,
          count(DISTINCT user_id) AS unique_users, {mean('amount')} AS avg_amount
        FROM txn GROUP BY 1, 2, 3""",
        TXN,
    )


def _chain(spark, d):
    """Stored hour states, merged into days."""
    view = maintained.hourly_revenue()
    hours = _states(spark, d, view)
    days = view.roll_up(hours, ["merchant_id", "category", times.day("hour").alias("day")])
    return view, days


@query("mv_chain_daily", _chained("day"))
def _(spark, d):
    view, days = _chain(spark, d)
    return read_states(days, ["merchant_id", "category", "day"], view.measures)


@query("mv_chain_monthly", _chained("month"))
def _(spark, d):
    view, days = _chain(spark, d)
    month = times.month_start("day").alias("month")
    months = view.roll_up(days, ["merchant_id", "category", month])
    return read_states(months, ["merchant_id", "category", "month"], view.measures)


@query(
    "mv_daily_merchant_summary",
    select(
        f"""SELECT merchant_id, CAST(created_at AS DATE) AS date, {AMOUNT} AS revenue,
          {COUNT} AS orders, count(DISTINCT user_id) AS customers, {mean('amount')} AS avg_order
        FROM txn WHERE status = 'completed' GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    view = maintained.daily_merchant_summary()
    return view.read(view.delta(views.txn(spark, d)))


@query(
    "mv_daily_summary",
    select(
        f"""SELECT CAST(created_at AS DATE) AS date, {COUNT} AS orders, {AMOUNT} AS revenue
        FROM txn WHERE status = 'completed' GROUP BY 1""",
        TXN,
    ),
)
def _(spark, d):
    view = maintained.daily_summary()
    return view.read(view.delta(views.txn(spark, d)))


# -- streams ----------------------------------------------------------------


def _event_stream(spark, d) -> DataFrame:
    """The events as a stream, read where they lie: one file, or a folder of files."""
    # In braces the name is a pattern, which may match a file as well as a folder.
    return pipelines.stream_files(spark, f"{d}/{{events.parquet}}", views.SCHEMAS["events"])


def _run(spark, d, wanted: list, prepare=views.as_transactions) -> str:
    """Feed the views from the event stream and return where they are stored."""
    root = shared_dir(spark, "views")
    running = pipelines.maintain(
        _event_stream(spark, d), wanted, root, f"{root}/_checkpoint", prepare
    )
    running.awaitTermination()
    return root


@query("stream_transactions_enriched", select(_ENRICHED, TXN))
def _(spark, d):
    view = maintained.enriched()
    root = _run(spark, d, [view])
    return view.read(pipelines.stored(spark, view, root)).drop("batch_id", "ym")


@query("stream_hourly_revenue", select(f"{_HOURLY} GROUP BY 1, 2, 3", TXN))
def _(spark, d):
    view = maintained.hourly_revenue()
    return view.read(pipelines.stored(spark, view, _run(spark, d, [view])))


@query("stream_user_spending", select(_SPENDING, TXN))
def _(spark, d):
    view = maintained.user_spending()
    return view.read(pipelines.stored(spark, view, _run(spark, d, [view])))


@query("stream_category_stats", select(_CATEGORY_STATS, TXN))
def _(spark, d):
    view = maintained.category_stats()
    return view.read(pipelines.stored(spark, view, _run(spark, d, [view])))


@query(
    "mv_fanout",
    select(
        f"""SELECT 'by_merchant' AS view, CAST(merchant_id AS VARCHAR) AS key,
          {AMOUNT} AS total_amount FROM txn GROUP BY merchant_id
        UNION ALL SELECT 'by_category', category, {AMOUNT} FROM txn GROUP BY category
        UNION ALL SELECT 'by_user', CAST(user_id AS VARCHAR), {AMOUNT} FROM txn GROUP BY user_id""",
        TXN,
    ),
)
def _(spark, d):
    """Three views fed by the same batches."""
    fed = [maintained.by_merchant(), maintained.by_category(), maintained.by_user()]
    root = _run(spark, d, fed)
    parts = []
    for view in fed:
        (key,) = view.keys
        rows = view.read(pipelines.stored(spark, view, root))
        parts.append(
            rows.select(
                F.lit(view.name).alias("view"),
                F.col(key).cast("string").alias("key"),
                "total_amount",
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "mv_join_snapshot",
    select(
        """SELECT t.transaction_id, t.merchant_id, t.amount, m.name AS merchant_name
        FROM txn t JOIN merchants m ON t.merchant_id = m.merchant_id""",
        TXN,
        MERCHANTS,
    ),
)
def _(spark, d):
    """Payments joined on arrival with the merchants as they are at that time."""

    def join(batch, dimension):
        return enrich(
            views.as_transactions(batch), dimension, "merchant_id", {"name": "merchant_name"}
        )

    prepare = pipelines.joined_at_arrival(lambda: views.merchants(spark, d), join)
    columns = ["transaction_id", "merchant_id", "amount", "merchant_name", "created_at"]
    view = maintained.RowView("with_names", lambda: columns)
    root = _run(spark, d, [view], prepare)
    return pipelines.stored(spark, view, root).drop("batch_id", "ym", "created_at")


@query(
    "stream_hourly_watermark",
    select(
        f"""SELECT date_trunc('hour', created_at) AS hour, {COUNT} AS transactions,
          {AMOUNT} AS revenue FROM txn GROUP BY 1""",
        TXN,
    ),
)
def _(spark, d):
    """Open hours are carried from batch to batch, late rows are stored apart and added."""
    root = shared_dir(spark, "hours")
    payments = views.as_transactions(_event_stream(spark, d))
    hours.maintain_hours(payments, f"{root}/out", f"{root}/_checkpoint").awaitTermination()
    return hours.hour_totals(spark, f"{root}/out")


@query(
    "stream_dedup",
    select(f"SELECT status, {COUNT} AS transactions, {AMOUNT} AS revenue FROM txn GROUP BY 1", TXN),
)
def _(spark, d):
    """Every event delivered twice, counted once, whether in one batch or in two."""
    root = shared_dir(spark, "unique")

    def thinned(batch):
        txn = views.as_transactions(batch)
        return pipelines.without_repeats(txn.unionByName(txn), ["transaction_id"])

    running = pipelines.write_batches(_event_stream(spark, d), thinned, f"{root}/out", f"{root}/_checkpoint")
    running.awaitTermination()
    stored = pipelines.without_repeats(pipelines.written(spark, f"{root}/out"), ["transaction_id"])
    return stored.groupBy("status").agg(
        F.count("*").alias("transactions"),
        F.sum("amount").cast("decimal(38,2)").alias("revenue"),
    )
