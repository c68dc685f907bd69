"""Analytical queries: aggregates, windows, ranks and joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tillflow.clock import one_day
from tillflow.operators.merges import latest_values
from tillflow.operators.quantiles import exact_quantiles, sketch_quantiles
from tillflow.plans import customers, merchants, reports, revenue, segments
from tillflow.registry import Registry
from tillflow.registry.sql_views import HIST, MERCHANTS, TXN, USERS, mean, select, total
from tillflow.sources import views

REGISTRY = Registry()
query = REGISTRY.add

# The moments that stand for "now" on the given, static tables.
AS_OF = datetime(2024, 1, 31)
HIST_AS_OF = datetime(2001, 8, 2)
USER_ID = 8
MERCHANT_ID = 7

AMOUNT, COUNT = total("amount"), "count(*)"
PAGE = """transaction_id, user_id, merchant_id, amount, currency, status, category,
  payment_method, created_at, processed_at"""


# -- scans, filters ---------------------------------------------------------


@query("scan_transactions", select(f"SELECT {PAGE} FROM txn", TXN))
def _(spark, d):
    return customers.payments(views.txn(spark, d))


@query(
    "txns_by_user",
    select(
        f"""SELECT {PAGE} FROM txn WHERE user_id = {USER_ID}
        ORDER BY created_at DESC, transaction_id LIMIT 20 OFFSET 5""",
        TXN,
    ),
)
def _(spark, d):
    return customers.payments_of(views.txn(spark, d), USER_ID, limit=20, offset=5)


@query(
    "day_range_filter",
    select(
        """SELECT transaction_id, user_id, amount, created_at FROM txn
        WHERE created_at >= TIMESTAMP '2024-01-15' AND created_at < TIMESTAMP '2024-01-16'""",
        TXN,
    ),
)
def _(spark, d):
    return one_day(views.txn(spark, d), datetime(2024, 1, 15)).select(
        "transaction_id", "user_id", "amount", "created_at"
    )


@query(
    "like_filter",
    select(
        f"""SELECT status, category, {COUNT} AS transactions, {AMOUNT} AS revenue FROM txn
        WHERE status LIKE 'p%' AND category <> '' AND payment_method <> 'card'
        GROUP BY status, category""",
        TXN,
    ),
)
def _(spark, d):
    rows = views.txn(spark, d).where(
        F.col("status").like("p%")
        & (F.col("category") != "")
        & (F.col("payment_method") != "card")
    )
    return rows.groupBy("status", "category").agg(
        F.count("*").alias("transactions"),
        F.sum("amount").cast("decimal(38,2)").alias("revenue"),
    )


@query(
    "having_heavy_groups",
    select(
        f"""SELECT category, status, {COUNT} AS transactions, {AMOUNT} AS revenue FROM txn
        GROUP BY category, status HAVING count(*) > 100""",
        TXN,
    ),
)
def _(spark, d):
    return segments.heavy_groups(views.txn(spark, d), 100)


@query("dim_merchants", select("SELECT * FROM merchants", MERCHANTS))
def _(spark, d):
    return views.merchants(spark, d)


@query("dim_users", select("SELECT * FROM users", USERS))
def _(spark, d):
    return views.users(spark, d)


# -- revenue ----------------------------------------------------------------


@query(
    "daily_revenue",
    select(
        f"""SELECT CAST(created_at AS DATE) AS txn_date, {COUNT} AS total_transactions,
          {AMOUNT} AS total_revenue, {mean('amount')} AS avg_transaction,
          min(amount) AS min_transaction, max(amount) AS max_transaction,
          count(DISTINCT user_id) AS unique_customers,
          count(DISTINCT merchant_id) AS unique_merchants
        FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' GROUP BY 1""",
        TXN,
    ),
)
def _(spark, d):
    return revenue.daily_revenue(views.txn(spark, d), 30, AS_OF)


@query(
    "total_stats",
    select(
        f"""SELECT {COUNT} AS total_transactions, {AMOUNT} AS total_volume,
          count(DISTINCT user_id) AS total_users, count(DISTINCT merchant_id) AS total_merchants,
          min(created_at) AS earliest_transaction, max(created_at) AS latest_transaction
        FROM txn""",
        TXN,
    ),
)
def _(spark, d):
    return revenue.total_stats(views.txn(spark, d))


@query(
    "revenue_by_merchant_range",
    select(
        f"""SELECT merchant_id, {COUNT} AS transaction_count, {AMOUNT} AS total_revenue,
          {mean('amount')} AS avg_transaction, min(amount) AS min_transaction,
          max(amount) AS max_transaction, count(DISTINCT user_id) AS unique_customers
        FROM txn WHERE status = 'completed'
          AND created_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'
        GROUP BY merchant_id ORDER BY total_revenue DESC, merchant_id LIMIT 20""",
        TXN,
    ),
)
def _(spark, d):
    lo, hi = datetime(2024, 1, 5), datetime(2024, 1, 25)
    return revenue.merchant_revenue(views.txn(spark, d), lo, hi, 20)


_TOP = f"""SELECT merchant_id, {COUNT} AS transaction_count, {AMOUNT} AS total_revenue,
  {mean('amount')} AS avg_transaction, count(DISTINCT user_id) AS unique_customers"""


@query(
    "top_merchants",
    select(
        f"""SELECT *, row_number() OVER (ORDER BY total_revenue DESC, merchant_id) AS revenue_rank
        FROM ({_TOP} FROM txn WHERE created_at >= TIMESTAMP '2024-01-01'
          AND status = 'completed' GROUP BY merchant_id)
        ORDER BY revenue_rank LIMIT 10""",
        TXN,
    ),
)
def _(spark, d):
    return revenue.top_merchants(views.txn(spark, d), 10, 30, AS_OF)


@query(
    "merchant_ranking",
    select(
        f"""SELECT *, row_number() OVER (ORDER BY total_revenue DESC, merchant_id) AS revenue_rank
        FROM ({_TOP} FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' GROUP BY merchant_id)
        ORDER BY revenue_rank LIMIT 20""",
        TXN,
    ),
)
def _(spark, d):
    return revenue.top_merchants(views.txn(spark, d), 20, 30, AS_OF, completed_only=False)


@query(
    "top_merchants_all_status",
    select(
        f"""{_TOP} FROM txn GROUP BY merchant_id
        ORDER BY total_revenue DESC, merchant_id LIMIT 10""",
        TXN,
    ),
)
def _(spark, d):
    return revenue.merchant_leaders(views.txn(spark, d), 10)


@query(
    "hourly_pattern",
    select(
        f"""SELECT CAST(hour(created_at) AS INTEGER) AS hour_of_day,
          CAST(isodow(created_at) AS INTEGER) AS day_of_week, {COUNT} AS transactions,
          {AMOUNT} AS revenue, {mean('amount')} AS avg_amount
        FROM txn WHERE created_at >= TIMESTAMP '2023-11-02' GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    return revenue.hourly_pattern(views.txn(spark, d), 90, AS_OF)


_HOURS = f"""SELECT date_trunc('hour', created_at) AS hour, {COUNT} AS transactions,
  {AMOUNT} AS revenue, {mean('amount')} AS avg_amount,
  count(DISTINCT user_id) AS unique_users, count(DISTINCT merchant_id) AS unique_merchants
  FROM txn WHERE created_at >= TIMESTAMP '2024-01-24' GROUP BY 1"""


@query("hourly_stats", select(_HOURS, TXN))
def _(spark, d):
    return revenue.hourly_stats(views.txn(spark, d), 7, AS_OF)


@query("recent_24_hours", select(f"{_HOURS} ORDER BY hour DESC LIMIT 24", TXN))
def _(spark, d):
    return revenue.recent_hours(views.txn(spark, d), 24, 7, AS_OF)


@query(
    "rolling_7d",
    select(
        f"""SELECT *, CAST(daily_revenue AS DOUBLE) - rolling_7d_avg AS deviation FROM (
          SELECT txn_date, daily_revenue,
            CAST(sum(daily_revenue) OVER w AS DOUBLE)
              / CAST(count(*) OVER w AS DOUBLE) AS rolling_7d_avg
          FROM (SELECT CAST(created_at AS DATE) AS txn_date, {AMOUNT} AS daily_revenue
            FROM txn WHERE created_at >= TIMESTAMP '2023-12-02' GROUP BY 1)
          WINDOW w AS (ORDER BY txn_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))""",
        TXN,
    ),
)
def _(spark, d):
    return revenue.rolling_average(views.txn(spark, d), 60, AS_OF)


_WEEKS = """SELECT week_start, revenue, prev_week_revenue,
  round(CAST(revenue - prev_week_revenue AS DOUBLE)
    / nullif(CAST(prev_week_revenue AS DOUBLE), 0) * 100, 2) AS wow_growth_pct
  FROM (SELECT *, lag(revenue) OVER (ORDER BY week_start) AS prev_week_revenue FROM ({weekly}))"""


@query(
    "wow_growth",
    select(
        _WEEKS.format(
            weekly=f"""SELECT CAST(created_at AS DATE) - CAST(dayofweek(created_at) AS INTEGER)
            AS week_start, {AMOUNT} AS revenue FROM txn
            WHERE created_at >= TIMESTAMP '2023-11-02' GROUP BY 1"""
        ),
        TXN,
    ),
)
def _(spark, d):
    return revenue.weekly_growth(views.txn(spark, d), 90, AS_OF)


@query(
    "wow_growth_monday",
    select(
        _WEEKS.format(
            weekly=f"""SELECT CAST(date_trunc('week', created_at) AS DATE) AS week_start,
            {AMOUNT} AS revenue FROM hist
            WHERE created_at >= TIMESTAMP '2001-05-04' GROUP BY 1"""
        ),
        HIST,
    ),
)
def _(spark, d):
    return revenue.weekly_growth(views.txn_hist(spark, d), 90, HIST_AS_OF, first_day="monday")


# -- users ------------------------------------------------------------------

_PROFILE = f"""SELECT user_id, {COUNT} AS total_transactions, {AMOUNT} AS total_spent,
  {mean('amount')} AS avg_transaction, min(created_at) AS first_transaction,
  max(created_at) AS last_transaction FROM txn GROUP BY user_id"""


@query(
    "user_profile",
    select(
        f"""SELECT *, CAST(total_spent AS DOUBLE) / CAST(greatest(active_days, 1) AS DOUBLE)
          AS daily_avg
        FROM (SELECT *, CAST(date_diff('day', first_transaction, last_transaction) AS INTEGER)
          AS active_days FROM ({_PROFILE}))""",
        TXN,
    ),
)
def _(spark, d):
    return customers.profile(views.txn(spark, d))


_WHOLE_DAYS = """CAST(floor(epoch(last_transaction - first_transaction) / 86400.0) AS INTEGER)"""
_FAVORITES = """favorites AS (
  SELECT c.user_id, favorite_category, favorite_merchant FROM
    (SELECT user_id, category AS favorite_category FROM
      (SELECT user_id, category, count(*) AS n FROM txn GROUP BY 1, 2)
     QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) = 1) c
  JOIN (SELECT user_id, merchant_id AS favorite_merchant FROM
      (SELECT user_id, merchant_id, count(*) AS n FROM txn GROUP BY 1, 2)
     QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, merchant_id) = 1) m
  ON c.user_id = m.user_id)"""


@query(
    "user_spending_summary",
    select(
        f"""SELECT u.user_id, total_transactions, total_spent, avg_transaction,
          first_transaction, last_transaction, {_WHOLE_DAYS} AS days_active,
          merchants_used, categories_used, favorite_category, favorite_merchant
        FROM ({_PROFILE}) u JOIN favorites f ON u.user_id = f.user_id
        JOIN (SELECT user_id, count(DISTINCT merchant_id) AS merchants_used,
          count(DISTINCT category) AS categories_used FROM txn GROUP BY user_id) k
          ON u.user_id = k.user_id
        WHERE u.user_id = {USER_ID}""",
        TXN,
        _FAVORITES,
    ),
)
def _(spark, d):
    return customers.spending_summary(views.txn(spark, d), USER_ID)


@query(
    "user_daily_average",
    select(
        f"""SELECT *, CASE WHEN days_active = 0 THEN 0.0
          ELSE CAST(total_spent AS DOUBLE) / CAST(days_active AS DOUBLE) END AS daily_average
        FROM (SELECT u.user_id, total_transactions, total_spent, avg_transaction,
          first_transaction, last_transaction, favorite_category,
          favorite_merchant AS favorite_merchant_id, {_WHOLE_DAYS} AS days_active
        FROM ({_PROFILE}) u JOIN favorites f ON u.user_id = f.user_id)""",
        TXN,
        _FAVORITES,
    ),
)
def _(spark, d):
    return customers.daily_average(views.txn(spark, d))


@query(
    "favorite_category",
    select(
        """SELECT user_id, category AS favorite_category, n AS favorite_category_count FROM
          (SELECT user_id, category, count(*) AS n FROM txn GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category) = 1""",
        TXN,
    ),
)
def _(spark, d):
    return customers.favorite_category(views.txn(spark, d))


@query(
    "cohort_retention",
    select(
        """SELECT CAST(date_trunc('month', first_at) AS DATE) AS cohort_month,
          CAST(date_diff('month', first_at, created_at) AS INTEGER) AS months_since_first,
          count(DISTINCT h.user_id) AS users
        FROM hist h JOIN (SELECT user_id, min(created_at) AS first_at FROM hist GROUP BY 1) f
          ON h.user_id = f.user_id
        GROUP BY 1, 2""",
        HIST,
    ),
)
def _(spark, d):
    return customers.cohort_retention(views.txn_hist(spark, d))


@query(
    "top_spenders_per_category",
    select(
        f"""SELECT *, row_number() OVER (PARTITION BY category
            ORDER BY total_spent DESC, user_id) AS rank_in_category
        FROM (SELECT category, user_id, {AMOUNT} AS total_spent, {COUNT} AS transactions
          FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' GROUP BY category, user_id)
        QUALIFY rank_in_category <= 5""",
        TXN,
    ),
)
def _(spark, d):
    return customers.top_spenders(views.txn(spark, d), 5, 30, AS_OF)


@query(
    "completed_spend_top100",
    select(
        f"""SELECT user_id, {AMOUNT} AS total FROM txn
        WHERE created_at >= TIMESTAMP '2024-01-01' AND status = 'completed'
        GROUP BY user_id ORDER BY total DESC, user_id LIMIT 100""",
        TXN,
    ),
)
def _(spark, d):
    return customers.completed_spend(views.txn(spark, d), 100, 30, AS_OF)


# -- categories and statuses ------------------------------------------------


def _share(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / CAST(sum({whole}) OVER () AS DOUBLE), 2)"


@query(
    "category_performance",
    select(
        f"""SELECT *, {_share('revenue', 'revenue')} AS revenue_share_pct,
          {_share('transactions', 'transactions')} AS transaction_share_pct
        FROM (SELECT category, {COUNT} AS transactions, {AMOUNT} AS revenue,
          {mean('amount')} AS avg_transaction, count(DISTINCT user_id) AS unique_users
          FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' GROUP BY category)""",
        TXN,
    ),
)
def _(spark, d):
    return segments.category_performance(views.txn(spark, d), 30, AS_OF)


@query(
    "category_breakdown",
    select(
        f"""SELECT *, {_share('transactions', 'transactions')} AS pct_transactions,
          {_share('revenue', 'revenue')} AS pct_revenue
        FROM (SELECT category, {COUNT} AS transactions, {AMOUNT} AS revenue,
          {mean('amount')} AS avg_transaction, count(DISTINCT user_id) AS unique_users,
          count(DISTINCT merchant_id) AS unique_merchants
          FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' GROUP BY category)""",
        TXN,
    ),
)
def _(spark, d):
    return segments.category_breakdown(views.txn(spark, d), 30, AS_OF)


@query(
    "category_trends",
    select(
        f"""SELECT CAST(date_trunc('month', created_at) AS DATE) AS month, category,
          {AMOUNT} AS revenue, {COUNT} AS transactions
        FROM hist WHERE created_at >= TIMESTAMP '2000-08-02' GROUP BY 1, 2""",
        HIST,
    ),
)
def _(spark, d):
    return segments.category_trends(views.txn_hist(spark, d), 365, HIST_AS_OF)


@query(
    "category_totals",
    select(
        f"""SELECT category, {COUNT} AS total_count, {AMOUNT} AS total_revenue FROM txn
        WHERE created_at >= TIMESTAMP '2023-01-31' GROUP BY category""",
        TXN,
    ),
)
def _(spark, d):
    return segments.category_totals(views.txn(spark, d), 365, AS_OF)


@query(
    "category_sample10",
    select(
        f"""SELECT category, {COUNT} * 10 AS total_count,
          CAST({AMOUNT} * 10 AS DECIMAL(38,2)) AS total_revenue
        FROM txn WHERE ('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8))::BIGINT % 10 = 0
        GROUP BY category""",
        TXN,
    ),
)
def _(spark, d):
    return segments.category_totals_sampled(views.txn(spark, d), 10, 365, AS_OF)


_STATUS = f"""SELECT *, {_share('transactions', 'transactions')} AS pct_of_total
  FROM (SELECT status, {COUNT} AS transactions, {AMOUNT} AS total_amount
    FROM txn WHERE created_at >= TIMESTAMP '2024-01-24' GROUP BY status)"""


@query("status_funnel", select(_STATUS, TXN))
def _(spark, d):
    return segments.status_funnel(views.txn(spark, d), 7, AS_OF)


@query("status_distribution", select(_STATUS, TXN))
def _(spark, d):
    return segments.status_distribution(views.txn(spark, d), 7, AS_OF)


@query(
    "failed_analysis",
    select(
        f"""SELECT CAST(created_at AS DATE) AS txn_date, category, {COUNT} AS failed_count,
          {AMOUNT} AS failed_amount,
          round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM txn
            WHERE created_at >= TIMESTAMP '2024-01-24' AND status = 'failed'), 2)
            AS pct_of_failures
        FROM txn WHERE status = 'failed' AND created_at >= TIMESTAMP '2024-01-24'
        GROUP BY 1, 2""",
        TXN,
    ),
)
def _(spark, d):
    return segments.failed_analysis(views.txn(spark, d), 7, AS_OF)


# -- joins ------------------------------------------------------------------

_NAMED = """SELECT t.*, m.name AS merchant_name, m.country_code AS merchant_country
  FROM txn t {how} JOIN merchants m ON t.merchant_id = m.merchant_id"""


@query("merchant_names_inner", select(_NAMED.format(how=""), TXN, MERCHANTS))
def _(spark, d):
    return merchants.with_names(views.txn(spark, d), views.merchants(spark, d), "inner")


@query("merchant_names_left", select(_NAMED.format(how="LEFT"), TXN, MERCHANTS))
def _(spark, d):
    return merchants.with_names(views.txn(spark, d), views.merchants(spark, d), "left")


@query(
    "usd_by_rates",
    select(
        """SELECT t.*, coalesce(r.rate, CAST(1 AS DECIMAL(10,4))) AS rate_to_usd,
          CAST(amount * coalesce(r.rate, CAST(1 AS DECIMAL(10,4))) AS DECIMAL(18,2))
            AS amount_usd
        FROM txn t LEFT JOIN (SELECT * FROM (VALUES
          ('USD', CAST(1 AS DECIMAL(10,4))), ('EUR', CAST(1.08 AS DECIMAL(10,4))),
          ('GBP', CAST(1.27 AS DECIMAL(10,4)))) AS v(currency, rate)) r
        ON t.currency = r.currency""",
        TXN,
    ),
)
def _(spark, d):
    return merchants.in_usd(views.txn(spark, d), views.currency_rates(spark))


@query(
    "merchant_summary",
    select(
        f"""SELECT b.*, m.name AS merchant_name FROM (
          SELECT *, row_number() OVER (ORDER BY total_revenue DESC, merchant_id) AS revenue_rank
          FROM (SELECT merchant_id, {AMOUNT} AS total_revenue, {COUNT} AS total_transactions,
            count(DISTINCT user_id) AS unique_customers, {mean('amount')} AS avg_transaction
            FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' AND status = 'completed'
            GROUP BY merchant_id) ORDER BY revenue_rank LIMIT 20) b
        LEFT JOIN merchants m ON b.merchant_id = m.merchant_id""",
        TXN,
        MERCHANTS,
    ),
)
def _(spark, d):
    return merchants.merchant_summary(
        views.txn(spark, d), views.merchants(spark, d), 20, 30, AS_OF
    )


# -- distinct counts, quantiles, frequent values ----------------------------


@query(
    "uniq_exact",
    select(
        """SELECT category, count(DISTINCT user_id) AS unique_users,
          count(DISTINCT merchant_id) AS unique_merchants FROM txn GROUP BY category""",
        TXN,
    ),
)
def _(spark, d):
    return customers.active_users_per_category(views.txn(spark, d))


@query("uniq_approx")
def _(spark, d):
    return customers.active_users_per_category(views.txn(spark, d), approx=True)


@query(
    "quantiles_exact",
    select(
        """SELECT category, round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 6) AS p50,
          round(quantile_cont(CAST(amount AS DOUBLE), 0.95), 6) AS p95,
          round(quantile_cont(CAST(amount AS DOUBLE), 0.99), 6) AS p99
        FROM txn GROUP BY category""",
        TXN,
    ),
)
def _(spark, d):
    out = exact_quantiles(views.txn(spark, d), ["category"], "amount", [0.5, 0.95, 0.99])
    return out.select("category", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99")])


@query("quantiles_approx")
def _(spark, d):
    return sketch_quantiles(views.txn(spark, d), ["category"], "amount", [0.5, 0.95, 0.99])


@query("topk_approx")
def _(spark, d):
    top = F.expr("approx_top_k(category, 1)")
    return (
        views.txn(spark, d)
        .groupBy("user_id")
        .agg(top.alias("top"))
        .select("user_id", F.col("top")[0]["item"].alias("favorite_category"))
    )


@query(
    "argmax_latest",
    select(
        """SELECT user_id, category AS last_category, amount AS last_amount,
          created_at AS last_at FROM txn
        QUALIFY row_number() OVER (PARTITION BY user_id
          ORDER BY created_at DESC, transaction_id DESC) = 1""",
        TXN,
    ),
)
def _(spark, d):
    newest = latest_values(
        views.txn(spark, d),
        ["user_id"],
        ["category", "amount", "created_at"],
        ["created_at", "transaction_id"],
    )
    return newest.select(
        "user_id",
        F.col("category").alias("last_category"),
        F.col("amount").alias("last_amount"),
        F.col("created_at").alias("last_at"),
    )


# -- reports ----------------------------------------------------------------


def _usd(value: str) -> str:
    return f"'$' || format('{{:,.2f}}', CAST(CAST({value} AS DECIMAL(38,2)) AS DOUBLE))"


def _int(value: str) -> str:
    return f"format('{{:,}}', CAST({value} AS BIGINT))"


def _pct(value: str) -> str:
    return f"format('{{:.1f}}', {value}) || '%'"


@query(
    "report_summary",
    select(
        f"""SELECT {_int('count(*)')} AS total_transactions, {_usd('sum(amount)')} AS total_volume,
          {_int('count(DISTINCT user_id)')} AS total_users,
          {_int('count(DISTINCT merchant_id)')} AS total_merchants,
          strftime(min(created_at), '%Y-%m-%d %H:%M:%S') AS data_from,
          strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS data_to
        FROM txn""",
        TXN,
    ),
)
def _(spark, d):
    return reports.summary(views.txn(spark, d))


@query(
    "report_revenue",
    select(
        f"""SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS date,
          {_int('count(*)')} AS transactions, {_usd('sum(amount)')} AS revenue,
          {_usd(mean('amount'))} AS avg_txn, {_int('count(DISTINCT user_id)')} AS customers,
          {_int('count(DISTINCT merchant_id)')} AS merchants
        FROM txn WHERE created_at >= TIMESTAMP '2024-01-24' GROUP BY CAST(created_at AS DATE)
        UNION ALL SELECT 'Total', {_int('count(*)')}, {_usd('sum(amount)')}, NULL, NULL, NULL
        FROM txn WHERE created_at >= TIMESTAMP '2024-01-24'""",
        TXN,
    ),
)
def _(spark, d):
    return reports.daily(views.txn(spark, d), 7, AS_OF)


@query(
    "report_user",
    select(
        f"""SELECT {_int('total_transactions')} AS total_transactions,
          {_usd('total_spent')} AS total_spent, {_usd('avg_transaction')} AS average_transaction,
          {_WHOLE_DAYS} AS days_active, merchants_used, categories_used, favorite_category,
          '#' || favorite_merchant AS favorite_merchant,
          strftime(first_transaction, '%Y-%m-%d %H:%M:%S') AS first_transaction,
          strftime(last_transaction, '%Y-%m-%d %H:%M:%S') AS last_transaction
        FROM ({_PROFILE}) u JOIN favorites f ON u.user_id = f.user_id
        JOIN (SELECT user_id, count(DISTINCT merchant_id) AS merchants_used,
          count(DISTINCT category) AS categories_used FROM txn GROUP BY user_id) k
          ON u.user_id = k.user_id
        WHERE u.user_id = {USER_ID}""",
        TXN,
        _FAVORITES,
    ),
)
def _(spark, d):
    return reports.user(views.txn(spark, d), USER_ID)


@query(
    "report_merchants",
    select(
        f"""SELECT row_number() OVER (ORDER BY total_revenue DESC, merchant_id) AS rank,
          '#' || merchant_id AS merchant, {_int('transaction_count')} AS transactions,
          {_usd('total_revenue')} AS revenue, {_usd('avg_transaction')} AS avg_txn,
          {_int('unique_customers')} AS customers
        FROM ({_TOP} FROM txn WHERE created_at >= TIMESTAMP '2024-01-01'
          AND status = 'completed' GROUP BY merchant_id)
        ORDER BY rank LIMIT 10""",
        TXN,
    ),
)
def _(spark, d):
    return reports.merchants(views.txn(spark, d), 10, 30, AS_OF)


@query(
    "report_category",
    select(
        f"""SELECT category, {_int('transactions')} AS transactions,
          {_pct(_share('transactions', 'transactions'))} AS pct_txns, {_usd('revenue')} AS revenue,
          {_pct(_share('revenue', 'revenue'))} AS pct_rev, {_usd('avg_transaction')} AS avg_txn
        FROM (SELECT category, {COUNT} AS transactions, {AMOUNT} AS revenue,
          {mean('amount')} AS avg_transaction
          FROM txn WHERE created_at >= TIMESTAMP '2024-01-01' GROUP BY category)""",
        TXN,
    ),
)
def _(spark, d):
    return reports.categories(views.txn(spark, d), 30, AS_OF)


@query(
    "report_status",
    select(
        f"""SELECT upper(status) AS status, {_int('transactions')} AS transactions,
          {_pct('pct_of_total')} AS pct_of_total, {_usd('total_amount')} AS total_amount
        FROM ({_STATUS})""",
        TXN,
    ),
)
def _(spark, d):
    return reports.statuses(views.txn(spark, d), 7, AS_OF)


@query(
    "report_hourly",
    select(
        f"""SELECT strftime(hour, '%Y-%m-%d %H:00') AS hour, {_int('transactions')} AS transactions,
          {_usd('revenue')} AS revenue, {_usd('avg_amount')} AS avg_txn,
          {_int('unique_users')} AS users
        FROM ({_HOURS} ORDER BY hour DESC LIMIT 24)""",
        TXN,
    ),
)
def _(spark, d):
    return reports.hourly(views.txn(spark, d), 7, AS_OF)
