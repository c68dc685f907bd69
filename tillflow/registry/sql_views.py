"""The payment views of ``tillflow.sources.views`` as SQL, for the checks."""

from __future__ import annotations

TXN = """txn AS (
  SELECT event_id AS transaction_id, user_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS merchant_id,
    CAST(value AS DECIMAL(18,2)) AS amount,
    CASE event_id % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
      WHEN 3 THEN 'CAD' WHEN 4 THEN 'AUD' ELSE 'JPY' END AS currency,
    CASE WHEN event_id % 100 < 5 THEN 'pending' WHEN event_id % 100 < 8 THEN 'processing'
      WHEN event_id % 100 < 88 THEN 'completed' WHEN event_id % 100 < 93 THEN 'failed'
      WHEN event_id % 100 < 97 THEN 'refunded' ELSE 'cancelled' END AS status,
    event_type AS category,
    CASE event_id % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'bank_transfer'
      WHEN 2 THEN 'wallet' ELSE 'crypto' END AS payment_method,
    ts AS created_at,
    CASE WHEN event_id % 100 BETWEEN 8 AND 96
      THEN ts + to_seconds(event_id % 60 + 1) END AS processed_at
  FROM events)"""

HIST = """hist AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS user_id,
    l_suppkey AS merchant_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing'
      ELSE 'pending' END AS status,
    o_orderpriority AS category, o_orderdate AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MERCHANTS = """merchants AS (
  SELECT s_suppkey AS merchant_id, s_name AS name, n_name AS country_code
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS username, n_name AS country_code,
    c_mktsegment AS tier,
    (SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

VERSIONS = """versions AS (
  SELECT transaction_id - transaction_id % 4 AS transaction_id, transaction_id AS sequence,
    user_id, merchant_id, amount, currency, status, category, created_at,
    created_at AS updated_at
  FROM txn)"""

LINE_VERSIONS = """line_versions AS (
  SELECT l_orderkey AS order_id, l_shipdate AS version, l_linenumber, l_partkey, l_suppkey,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
    CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym
  FROM lineitem)"""

CHANGES = """changes AS (
  SELECT user_id AS customer_id, event_type AS name,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_deleted,
    event_id AS _version, ts AS _ts
  FROM events)"""

SIGNED = """signed AS (
  SELECT event_id AS key, CAST(value AS DECIMAL(18,2)) AS balance, 1 AS sign, 1 AS version
  FROM events
  UNION ALL SELECT event_id, CAST(value AS DECIMAL(18,2)), -1, 1
  FROM events WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) + 1 AS DECIMAL(18,2)), 1, 2
  FROM events WHERE event_id % 3 = 0)"""

METRICS = """metrics AS (
  SELECT event_type AS metric_name, ts AS "timestamp", value, CAST(1 AS BIGINT) AS "count"
  FROM events)"""


def select(query: str, *views: str) -> str:
    """A query over the named views."""
    return "WITH " + ",\n".join(views) + "\n" + query.strip()


def total(column: str) -> str:
    return f"CAST(sum({column}) AS DECIMAL(38,2))"


def mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / CAST(count({column}) AS DOUBLE)"
