"""Layouts, age rules and table statistics."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from tillflow.functions import times
from tillflow.operators import layouts, lifecycle, table_stats
from tillflow.operators.ranking import distinct
from tillflow.plans import segments
from tillflow.registry import Registry
from tillflow.registry.analytics import AS_OF, HIST_AS_OF, MERCHANT_ID
from tillflow.registry.sql_views import HIST, METRICS, TXN, USERS, mean, select, total
from tillflow.session import discard, shared_dir
from tillflow.sources import copies, tables, views
from tillflow.sources.tables import clustered

REGISTRY = Registry()
query = REGISTRY.add

AMOUNT, COUNT = total("amount"), "count(*)"


# -- layouts: copies in the shared folder that follow the files of their table ------


def _layout(spark, d, layout):
    def add(paths: list[str], folder: str) -> None:
        events = spark.read.schema(views.SCHEMAS["events"]).parquet(*paths)
        layouts.materialize(layout, views.as_transactions(events), folder)

    def merge(folders: list[str], folder: str) -> None:
        layout.merge(copies.stored(spark, folders)).write.parquet(folder)

    return copies.copy_of(spark, f"{d}/events.parquet", layout.name, add, merge)


def _monthly(spark, d, table: str, ts: str):
    """A copy of a table in folders of months."""

    def add(paths: list[str], folder: str) -> None:
        rows = spark.read.schema(views.SCHEMAS[table]).parquet(*paths)
        rows = rows.withColumn("ym", times.yyyymm(ts))
        clustered(rows, ["ym", ts]).write.partitionBy("ym").parquet(folder)

    return copies.copy_of(spark, f"{d}/{table}.parquet", f"monthly-{table}", add)


@query(
    "layout_by_merchant",
    select(
        f"""SELECT merchant_id, {COUNT} AS txn_count, {AMOUNT} AS revenue,
          count(DISTINCT user_id) AS unique_users
        FROM txn WHERE merchant_id = {MERCHANT_ID} AND created_at >= TIMESTAMP '2024-01-15'
        GROUP BY merchant_id""",
        TXN,
    ),
)
def _(spark, d):
    copy = _layout(spark, d, layouts.BY_MERCHANT)
    mine = copy.where(
        (F.col("merchant_id") == MERCHANT_ID)
        & (F.col("created_at") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    )
    return mine.groupBy("merchant_id").agg(
        F.count("*").alias("txn_count"),
        F.sum("amount").cast("decimal(38,2)").alias("revenue"),
        distinct("user_id").alias("unique_users"),
    )


@query(
    "layout_by_category",
    select(
        f"""SELECT category, CAST(created_at AS DATE) AS day, {COUNT} AS txn_count,
          {AMOUNT} AS revenue FROM txn WHERE category = 'purchase' GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    copy = _layout(spark, d, layouts.BY_CATEGORY).where(F.col("category") == "purchase")
    return copy.groupBy("category", times.day("created_at").alias("day")).agg(
        F.count("*").alias("txn_count"), F.sum("amount").cast("decimal(38,2)").alias("revenue")
    )


@query(
    "layout_daily_merchant",
    select(
        f"""SELECT merchant_id, CAST(created_at AS DATE) AS txn_date, {COUNT} AS txn_count,
          {AMOUNT} AS total_amount, {mean('amount')} AS avg_amount
        FROM txn GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    layout = layouts.daily_merchant()
    return layout.read(_layout(spark, d, layout))


@query(
    "layout_status_hourly",
    select(
        f"""SELECT status, date_trunc('hour', created_at) AS hour, {COUNT} AS txn_count,
          {AMOUNT} AS total_amount FROM txn GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    layout = layouts.hourly_status()
    return layout.read(_layout(spark, d, layout))


@query(
    "merchant_recent100",
    select(
        f"""SELECT {', '.join(layouts.COPIED)} FROM txn WHERE merchant_id = {MERCHANT_ID}
        ORDER BY created_at DESC, transaction_id LIMIT 100""",
        TXN,
    ),
)
def _(spark, d):
    return layouts.newest_of_merchant(
        _layout(spark, d, layouts.BY_MERCHANT), MERCHANT_ID, 100
    )


_SAMPLED = select(
    f"""SELECT category, {COUNT} * 10 AS total_count,
      CAST({AMOUNT} * 10 AS DECIMAL(38,2)) AS total_revenue
    FROM txn WHERE ('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 10 = 0
    GROUP BY category""",
    TXN,
)


def _user_sample(spark, d):
    """Payments of one user in ten, from a copy that keeps the slots of users apart."""
    layout = layouts.BY_USER_SAMPLE

    def add(paths: list[str], folder: str) -> None:
        events = spark.read.schema(views.SCHEMAS["events"]).parquet(*paths)
        layout.save(views.as_transactions(events), folder)

    return layout.sample(copies.copy_of(spark, f"{d}/events.parquet", layout.name, add))


@query("category_sample10_layout", _SAMPLED)
def _(spark, d):
    """The totals of ``category_sample10`` from a tenth of the files."""
    return (
        _user_sample(spark, d)
        .groupBy("category")
        .agg(
            (F.count("*") * 10).alias("total_count"),
            (F.sum("amount") * 10).cast("decimal(38,2)").alias("total_revenue"),
        )
    )


@query(
    "category_sample10_interval",
    select(
        """SELECT category, CAST(sum(n) * 10 AS BIGINT) AS total_count,
          round(sum(spent) * 10, 2) AS total_revenue,
          round(sum(spent) * 10 - 1.96 * sqrt(sum(spent * spent) * 90), 2) AS revenue_low,
          round(sum(spent) * 10 + 1.96 * sqrt(sum(spent * spent) * 90), 2) AS revenue_high
        FROM (SELECT category, user_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS spent
          FROM txn WHERE ('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 10 = 0
          GROUP BY 1, 2)
        GROUP BY category""",
        TXN,
    ),
)
def _(spark, d):
    return segments.category_totals_interval(_user_sample(spark, d), 10)


# -- partitions of catalog tables --------------------------------------------


@query(
    "partition_round_trip",
    """SELECT CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'archive' ELSE 'table' END AS place,
      CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS ym, count(*) AS orders,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total,
      min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
    FROM orders GROUP BY 1, 2""",
)
def _(spark, d):
    """Orders by month after a month was detached, filled, attached and compacted, and 1995 archived.

    Half of the rows come while months are detached and after they were archived.
    """
    database, name = "tillflow_scratch", f"orders_{uuid.uuid4().hex[:12]}"
    table, archive = f"{database}.{name}", f"{database}.{name}_archive"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    orders = views.table(spark, d, "orders").withColumn("ym", times.yyyymm("o_orderdate"))
    schema = orders.schema
    for t in (table, archive, f"{table}_detached"):
        tables.create_table(spark, t, schema, ["ym"], location=shared_dir(spark, "round-trip"))
    early, late = (tables.clustered(orders.where(F.col("o_orderkey") % 2 == k), ["ym", "o_orderkey"]) for k in (0, 1))
    month, year = {"ym": 199703}, [{"ym": 199500 + m} for m in range(1, 13)]
    tables.append(early, table, ["ym"])
    tables.detach_partition(spark, table, month)
    for old in year:
        tables.move_partition(spark, table, archive, old)
    tables.append(late, table, ["ym"])
    tables.attach_partition(spark, table, month)
    tables.compact(spark, table, month, lambda rows: rows, ["ym", "o_orderkey"])
    for old in year:
        tables.move_partition(spark, table, archive, old)
    placed = [spark.table(t).withColumn("place", F.lit(p)) for t, p in ((table, "table"), (archive, "archive"))]
    path = shared_dir(spark, "round-trip-months")
    placed[0].unionByName(placed[1]).groupBy("place", "ym").agg(
        F.count("*").alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    ).write.parquet(path)
    for t in (table, archive, f"{table}_detached"):
        at = tables.location(spark, t)
        tables.drop_table(spark, t)
        discard(spark, at)
    return spark.read.parquet(path)


# -- age rules --------------------------------------------------------------


@query(
    "ttl_delete",
    select(
        """SELECT transaction_id, user_id, merchant_id, amount, status, category, created_at
        FROM hist WHERE created_at + INTERVAL 2 YEAR > TIMESTAMP '2001-08-02'""",
        HIST,
    ),
)
def _(spark, d):
    kept = lifecycle.expire_rows(views.txn_hist(spark, d), "created_at", HIST_AS_OF, years=2)
    return kept.drop("part_id")


@query(
    "ttl_delete_days",
    select(
        """SELECT transaction_id, user_id, amount, created_at
        FROM txn WHERE created_at + INTERVAL 14 DAY > TIMESTAMP '2024-01-31'""",
        TXN,
    ),
)
def _(spark, d):
    kept = lifecycle.expire_rows(views.txn(spark, d), "created_at", AS_OF, days=14)
    return kept.select("transaction_id", "user_id", "amount", "created_at")


@query(
    "ttl_columns",
    select(
        """SELECT user_id, username, country_code, created_at,
          CASE WHEN created_at + INTERVAL 1 YEAR <= TIMESTAMP '1996-06-01'
            THEN NULL ELSE username || '@example.com' END AS email,
          CASE WHEN created_at + INTERVAL 6 MONTH <= TIMESTAMP '1996-06-01'
            THEN NULL ELSE '+1-555-' || user_id END AS phone
        FROM users""",
        USERS,
    ),
)
def _(spark, d):
    """Users without a time keep their columns: they never expire."""
    people = views.users(spark, d).select(
        "user_id",
        "username",
        "country_code",
        "created_at",
        F.concat("username", F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.col("user_id").cast("string")).alias("phone"),
    )
    ages = {"email": {"years": 1}, "phone": {"months": 6}}
    return lifecycle.expire_columns(people, "created_at", ages, datetime(1996, 6, 1))


@query(
    "ttl_rollup",
    select(
        """SELECT metric_name, date_trunc('hour', "timestamp") AS "timestamp",
          round(sum(value), 6) AS value, CAST(sum("count") AS BIGINT) AS "count"
        FROM metrics WHERE "timestamp" + INTERVAL 7 DAY <= TIMESTAMP '2024-01-31' GROUP BY 1, 2
        UNION ALL SELECT metric_name, "timestamp", round(value, 6), "count" FROM metrics
        WHERE "timestamp" + INTERVAL 7 DAY > TIMESTAMP '2024-01-31'""",
        METRICS,
    ),
)
def _(spark, d):
    rolled = lifecycle.roll_up(
        views.metrics(spark, d), ["metric_name"], "timestamp", ["value", "count"], AS_OF, 7
    )
    return rolled.withColumn("value", F.round("value", 6))


@query(
    "ttl_tier_class",
    select(
        """SELECT CASE WHEN created_at + INTERVAL 365 DAY <= TIMESTAMP '2001-08-02' THEN 'expired'
            WHEN created_at + INTERVAL 90 DAY <= TIMESTAMP '2001-08-02' THEN 'cold'
            WHEN created_at + INTERVAL 30 DAY <= TIMESTAMP '2001-08-02' THEN 'warm'
            ELSE 'hot' END AS tier, count(*) AS transactions,
          min(created_at) AS oldest, max(created_at) AS newest
        FROM hist GROUP BY 1""",
        HIST,
    ),
)
def _(spark, d):
    tiered = views.txn_hist(spark, d).withColumn("tier", lifecycle.tier("created_at", HIST_AS_OF))
    return tiered.groupBy("tier").agg(
        F.count("*").alias("transactions"),
        F.min("created_at").alias("oldest"),
        F.max("created_at").alias("newest"),
    )


# -- table statistics -------------------------------------------------------


@query("partition_stats")
def _(spark, d):
    return table_stats.partition_stats(_monthly(spark, d, "lineitem", "l_shipdate"), "ym")


@query(
    "partition_rows",
    """SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS "partition",
      count(*) AS "rows" FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    """The part of the partition statistics that doesn't depend on how files were written."""
    stats = table_stats.partition_stats(_monthly(spark, d, "lineitem", "l_shipdate"), "ym")
    return stats.select("partition", "rows")


@query("small_files")
def _(spark, d):
    """Months of orders that are spread over more than one file."""

    def add(paths: list[str], folder: str) -> None:
        orders = spark.read.schema(views.SCHEMAS["orders"]).parquet(*paths)
        orders = orders.withColumn("ym", times.yyyymm("o_orderdate"))
        tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
        orders.repartition(tasks).write.partitionBy("ym").parquet(folder)

    copy = copies.copy_of(spark, f"{d}/orders.parquet", "scattered-orders", add)
    return table_stats.many_files(copy, "ym", more_than=1)


@query("table_size")
def _(spark, d):
    return table_stats.table_size(spark, f"{d}/lineitem.parquet", "lineitem")


@query("column_sizes")
def _(spark, d):
    return table_stats.column_sizes(spark, f"{d}/lineitem.parquet")
