"""Payment tables derived from the given Parquet tables.

Each function takes a session and a folder of ``<table>.parquet`` files and
returns a lazy DataFrame; ``tillflow.registry.sql_views`` has the same
derivations as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.times import yyyymm


# Declared schemas, so that planning a query does not start a job to infer them.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    result = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        result = F.when(index == i, F.lit(values[i])).otherwise(result)
    return result


def as_transactions(events: DataFrame) -> DataFrame:
    """Events as payments; works on batch and on streaming DataFrames."""
    e = F.col("event_id")
    slot = e % 100
    status = (
        F.when(slot < 5, "pending")
        .when(slot < 8, "processing")
        .when(slot < 88, "completed")
        .when(slot < 93, "failed")
        .when(slot < 97, "refunded")
        .otherwise("cancelled")
    )
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), e % 60 + 1)
    done = status.isin("completed", "failed", "refunded")
    return events.select(
        e.alias("transaction_id"),
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("merchant_id"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        _pick(e % 6, ["USD", "EUR", "GBP", "CAD", "AUD", "JPY"]).alias("currency"),
        status.alias("status"),
        F.col("event_type").alias("category"),
        _pick(e % 4, ["card", "bank_transfer", "wallet", "crypto"]).alias("payment_method"),
        F.col("ts").alias("created_at"),
        F.when(done, F.col("ts") + delay).alias("processed_at"),
    )


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(table(spark, sf_dir, "events"))


def txn_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as payments over several years."""
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    letter = F.col("o_orderstatus")
    status = (
        F.when(letter == "F", "completed").when(letter == "O", "processing").otherwise("pending")
    )
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        status.alias("status"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_partkey").alias("part_id"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("country_code"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    first_order = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("created_at"))
    )
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first_order, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("n_name").alias("country_code"),
            F.col("c_mktsegment").alias("tier"),
            "created_at",
        )
    )


def currency_rates(spark: SparkSession) -> DataFrame:
    """Rates to USD by currency; a parameter table of a few rows."""
    from tillflow.functions.money import USD_RATES

    values = ", ".join(f"('{c}', cast({r} as decimal(10,4)))" for c, r in USD_RATES.items())
    return spark.sql(f"SELECT * FROM VALUES {values} AS rates(currency, rate_to_usd)")


def txn_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions of each payment; a later event is a newer version."""
    t = txn(spark, sf_dir)
    e = F.col("transaction_id")
    return t.select(
        (e - e % 4).alias("transaction_id"),
        e.alias("sequence"),
        "user_id",
        "merchant_id",
        "amount",
        "currency",
        "status",
        "category",
        "created_at",
        F.col("created_at").alias("updated_at"),
    )


def line_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of an order across months; the last columns break ties."""
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("version"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        yyyymm("l_shipdate").alias("ym"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of customers, ordered by log offset."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("name"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_deleted"),
        F.col("event_id").alias("_version"),
        F.col("ts").alias("_ts"),
    )


def signed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with signs: every third payment is cancelled and re-entered as v2."""
    events = table(spark, sf_dir, "events")
    amount = F.col("value").cast("decimal(18,2)")

    def entry(value: Column, sign: int, version: int) -> Column:
        return F.struct(
            value.cast("decimal(18,2)").alias("balance"),
            F.lit(sign).alias("sign"),
            F.lit(version).alias("version"),
        )

    corrected = F.array(entry(amount, 1, 1), entry(amount, -1, 1), entry(amount + 1, 1, 2))
    plain = F.array(entry(amount, 1, 1))
    rows = F.when(F.col("event_id") % 3 == 0, corrected).otherwise(plain)
    return events.select(F.col("event_id").alias("key"), F.inline(rows))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("metric_name"),
        F.col("ts").alias("timestamp"),
        "value",
        F.lit(1).cast("long").alias("count"),
    )
