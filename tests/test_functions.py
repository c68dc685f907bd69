from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillflow import checks
from tillflow.functions import enums, money, sampling, times


def one(spark, expression, value=None, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression).first()[0]


@pytest.mark.parametrize(
    "raw, name", [("completed", "completed"), ("COMPLETED", "completed"), ("3", "completed"),
                  ("1", "pending"), ("6", "cancelled"), ("not_a_status", None), ("9", None)]
)
def test_enum_coercion(spark, raw, name):
    assert one(spark, enums.coerce("x"), raw) == name


def test_enum_codes_round_trip(spark):
    rows = spark.createDataFrame([(n,) for n in enums.STATUS_CODES], "x string")
    back = rows.select("x", enums.name_of(enums.code_of("x")).alias("y")).collect()
    assert all(r.x == r.y for r in back) and len(back) == 6


def test_unknown_enum_fails_the_job(spark):
    with pytest.raises(PySparkException, match="invalid value not_a_status"):
        one(spark, enums.require("x"), "not_a_status")
    assert one(spark, enums.require("x"), "2") == "processing"


def test_quarantine_split(spark):
    rows = spark.createDataFrame([("FAILED",), ("5",), ("odd",), (None,)], "x string")
    good, bad = enums.split_valid(rows, "x")
    assert sorted(r.x for r in good.collect()) == ["failed", "refunded"]
    assert {r.x for r in bad.collect()} == {"odd", None}


@pytest.mark.parametrize(
    "text, amount", [(None, "0.00"), ("123.45", "123.45"), ("not-a-number", "0.00")]
)
def test_decimal_parse(spark, text, amount):
    assert one(spark, money.parse_amount("x"), text) == Decimal(amount)


def test_conversion_rounds_half_up_and_keeps_other_currencies(spark):
    rows = [("USD", "10.00"), ("EUR", "10.03"), ("GBP", "0.50"), ("JPY", "77.00")]
    df = spark.createDataFrame(rows, "cur string, a string")
    usd = money.to_usd(F.col("a").cast("decimal(18,2)"), F.col("cur"))
    got = [r[0] for r in df.select(usd).collect()]
    # 10.03 * 1.08 = 10.8324, 0.50 * 1.27 = 0.635
    assert got == [Decimal("10.00"), Decimal("10.83"), Decimal("0.64"), Decimal("77.00")]


@pytest.mark.parametrize(
    "size, text", [(0, "0.00 B"), (1023, "1023.00 B"), (1024, "1.00 KiB"),
                   (1536 * 1024, "1.50 MiB"), (5 * 1024**4, "5.00 TiB")]
)
def test_readable_size(spark, size, text):
    assert one(spark, money.readable_size("x"), size, "long") == text


def test_sizes_beyond_a_long(spark, tmp_path):
    from tillflow import registry

    keys = [(9_000_000, 900_000), (94_906_267, 1_021), (1_000, 3)]
    rows = spark.createDataFrame(keys, "o_orderkey long, o_custkey long")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.queries()["readable_size"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == {
        (9_000_000, "64748.21 PiB"), (94_906_267, "8168.00 PiB"), (1_000, "2.86 MiB"),
    }
    top = 2**63 - 1
    triples = [(top, top, top), (94_906_267, 94_906_267, 1_021), (9_000_001, 9_000_001, 900_001), (1, 2, None)]
    far = spark.createDataFrame(triples, "a long, b long, c long")
    product = [r[0] for r in far.select(money.product("a", "b", "c")).collect()]
    assert product == [float(2**189), float(94_906_267**2 * 1_021), float(9_000_001**2 * 900_001), None]


def test_display_text(spark):
    assert one(spark, money.dollars("x"), Decimal("1234567.5"), "decimal(18,2)") == "$1,234,567.50"
    assert one(spark, money.grouped("x"), 1234567, "long") == "1,234,567"
    assert one(spark, money.percent_text("x"), 12.34, "double") == "12.3%"


def test_calendar(spark):
    sunday = datetime(2024, 1, 7, 13, 45, 59)

    def at(expression):
        return one(spark, expression, sunday, "timestamp_ntz")

    assert at(times.iso_weekday("x")) == 7
    assert at(times.is_weekend("x")) == 1
    assert at(times.week_start("x")) == date(2024, 1, 7)
    assert at(times.week_start("x", "monday")) == date(2024, 1, 1)
    assert at(times.hour_start("x")) == datetime(2024, 1, 7, 13)
    assert at(times.month_start("x")) == date(2024, 1, 1)
    assert at(times.yyyymm("x")) == 202401
    assert at(times.yyyymmdd("x")) == 20240107
    with pytest.raises(ValueError, match="first_day"):
        times.week_start("x", "friday")


def test_two_kinds_of_days(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 23), datetime(2024, 1, 3, 1))], "a timestamp_ntz, b timestamp_ntz"
    )
    row = df.select(
        times.days_between("a", "b"), times.whole_days_between("a", "b"),
        times.months_between_grid("a", "b"),
    ).first()
    assert tuple(row) == (2, 1, 0)


def test_month_grid_ignores_the_day(spark):
    df = spark.createDataFrame([(date(2023, 12, 31), date(2024, 1, 1))], "a date, b date")
    assert df.select(times.months_between_grid("a", "b")).first()[0] == 1


def test_month_end_arithmetic(spark):
    value = one(spark, times.plus("x", months=1), datetime(2024, 1, 31), "timestamp_ntz")
    assert value == datetime(2024, 2, 29)


def test_sample_keeps_whole_keys(spark):
    rows = spark.range(20000).select((F.col("id") % 1000).alias("k"))
    kept = rows.where(sampling.keep_one_in("k", 10)).groupBy("k").count().collect()
    assert {r["count"] for r in kept} == {20}
    assert 60 <= len(kept) <= 140


@pytest.mark.parametrize("value", [0, -1, 1.5, True, "3"])
def test_checks_name_the_argument(value):
    with pytest.raises(ValueError, match="limit"):
        checks.positive("limit", value)


def test_total_is_exact_for_extreme_and_negative_amounts(spark):
    values = ["9999999999999999.99", "9999999999999999.99", "-0.01", "-10485.77", "0.01", None]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    df = df.select(F.col("a").cast("decimal(18,2)").alias("a"))
    many = df.crossJoin(spark.range(50)).drop("id")
    got, plain = many.agg(money.total("a"), F.sum("a")).first()
    assert got == plain == 50 * sum(Decimal(v) for v in values if v)
    assert df.where("a is null").agg(money.total("a")).first()[0] is None
