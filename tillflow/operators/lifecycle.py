"""Age rules: expiry of rows and columns, roll-up, tiers, recompression."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.checks import positive
from tillflow.clock import moment, now
from tillflow.functions import times
from tillflow.sources import tables


def expired(ts: str, as_of: datetime | None = None, **age: int) -> Column:
    """Whether ``ts`` plus an age (``days=``, ``months=``, ``years=``) has passed.

    Written as a bound on ``ts`` itself where the age is in days, so that the
    condition can be pushed to the scan; months and years add to ``ts`` because
    calendar additions do not invert at month ends.  A row without a time never expires.
    """
    for name, value in age.items():
        positive(name, value)
    cut = moment(now(as_of))
    if set(age) == {"days"}:
        return F.coalesce(F.col(ts) <= times.plus(cut, days=-age["days"]), F.lit(False))
    return F.coalesce(times.plus(ts, **age) <= cut, F.lit(False))


def _fresh_bound(ts: str, as_of: datetime | None, **age: int) -> Column:
    """A bound on ``ts`` alone that every row that hasn't expired meets."""
    cut = moment(now(as_of))
    slack = 0 if set(age) == {"days"} else 3  # days by which calendar additions may differ
    back = {k: -v for k, v in age.items()} | {"days": -age.get("days", 0) - slack}
    return F.col(ts).isNull() | (F.col(ts) > times.plus(cut, **back))


def expire_rows(df: DataFrame, ts: str, as_of: datetime | None = None, **age: int) -> DataFrame:
    """Rows that have not expired; rows without a time never do."""
    return df.where(_fresh_bound(ts, as_of, **age) & ~expired(ts, as_of, **age))


def expire_columns(
    df: DataFrame, ts: str, ages: dict[str, dict[str, int]], as_of: datetime | None = None
) -> DataFrame:
    """NULL in each listed column once its own age has passed."""
    cleared = {
        column: F.when(~expired(ts, as_of, **age), F.col(column)) for column, age in ages.items()
    }
    return df.withColumns(cleared)


def roll_up(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    sums: Sequence[str],
    as_of: datetime | None = None,
    days: int = 7,
) -> DataFrame:
    """Old rows summed per hour, recent rows unchanged.

    One pass: recent rows are routed past the aggregation by a union of two
    filtered scans; both filters are bounds on ``ts`` and reach the scan.
    """
    columns = [*keys, ts, *sums]
    bound = F.col(ts) <= times.plus(moment(now(as_of)), days=-positive("days", days))
    old = df.where(bound)
    recent = df.where(~bound | F.col(ts).isNull()).select(*columns)
    hourly = (
        old.groupBy(*keys, times.hour_start(ts).alias(ts))
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select(*columns)
    )
    return hourly.unionByName(recent)


def tier(
    ts: str,
    as_of: datetime | None = None,
    days: Sequence[int] = (30, 90, 365),
    names: Sequence[str] = ("hot", "warm", "cold", "expired"),
) -> Column:
    """Tier of a row by its age: one name more than there are limits."""
    if len(names) != len(days) + 1:
        raise ValueError("names must have one entry more than days")
    result = F.lit(names[0])
    for limit, name in zip(days, names[1:]):
        result = F.when(expired(ts, as_of, days=limit), F.lit(name)).otherwise(result)
    return result


# -- jobs over monthly tables ----------------------------------------------


def _months(spark: SparkSession, table: str) -> list[int]:
    """Months a table has, by itself or with other keys, from the catalog (no data is read)."""
    return sorted({p["ym"] for p in tables.partitions_of(spark, table) if p["ym"] is not None})


def _next_month(ym: int) -> datetime:
    year, month = divmod(ym, 100)
    return datetime(year + month // 12, month % 12 + 1, 1)


def drop_expired(
    spark: SparkSession, table: str, ts: str, days: int, as_of: datetime | None = None
) -> list[int]:
    """Expire rows of a monthly table and return the months that were dropped.

    Months that are wholly expired are dropped from the catalog; only the month
    that holds the limit is rewritten.
    """
    from datetime import timedelta

    limit = now(as_of) - timedelta(days=positive("days", days))
    dropped = []
    for ym in _months(spark, table):
        if _next_month(ym) <= limit:
            tables.drop_partition(spark, table, {"ym": ym})
            dropped.append(ym)
        elif ym <= limit.year * 100 + limit.month:
            tables.compact(
                spark,
                table,
                {"ym": ym},
                lambda rows: expire_rows(rows, ts, as_of, days=days),
                ["ym", ts],
            )
    return dropped


def move_old_months(
    spark: SparkSession, table: str, target: str, days: int, as_of: datetime | None = None
) -> list[int]:
    """Move months that ended at least ``days`` days ago to another table."""
    from datetime import timedelta

    limit = now(as_of) - timedelta(days=positive("days", days))
    old = [ym for ym in _months(spark, table) if _next_month(ym) <= limit]
    moved = [ym for ym in old if tables.partition_files(spark, table, {"ym": ym})]
    for ym in moved:
        tables.move_partition(spark, table, target, {"ym": ym})
    return moved


def recompress(
    df: DataFrame, path: str, order: Sequence[str], level: int = 9, partitions: int | None = None
) -> None:
    """Rewrite rows with a denser codec."""
    (
        tables.clustered(df, order, partitions)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(positive("level", level)))
        .parquet(path)
    )
