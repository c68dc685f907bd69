"""Look-back filters relative to an explicit moment.

Bounds are literals computed on the driver, so they reach the Parquet scan as
pushed filters.  A table partitioned by month carries an ``ym`` column; the
matching bound on it is added so that whole months are pruned.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.checks import positive

MONTH_KEY = "ym"


def now(as_of: datetime | None = None) -> datetime:
    """``as_of`` or the current UTC time without a zone."""
    return as_of or datetime.now(timezone.utc).replace(tzinfo=None)


def moment(value: datetime) -> Column:
    """A zone-less timestamp literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def midnight_before(as_of: datetime | None, days: int) -> datetime:
    """Midnight ``days`` days before the day of ``as_of``."""
    start = now(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return start - timedelta(days=days)


def _month(value: datetime) -> int:
    return value.year * 100 + value.month


def time_range(
    df: DataFrame,
    lo: datetime | None = None,
    hi: datetime | None = None,
    *,
    ts: str = "created_at",
    hi_inclusive: bool = True,
) -> DataFrame:
    """Rows between two moments, pruning months where the table has them."""
    monthly = MONTH_KEY in df.columns
    if lo is not None:
        df = df.where(F.col(ts) >= moment(lo))
        if monthly:
            df = df.where(F.col(MONTH_KEY) >= _month(lo))
    if hi is not None:
        bound = moment(hi)
        df = df.where(F.col(ts) <= bound if hi_inclusive else F.col(ts) < bound)
        if monthly:
            df = df.where(F.col(MONTH_KEY) <= _month(hi))
    return df


def last_days(
    df: DataFrame, days: int, as_of: datetime | None = None, ts: str = "created_at"
) -> DataFrame:
    """Rows since midnight ``days`` days ago."""
    return time_range(df, midnight_before(as_of, positive("days", days)), ts=ts)


def last_hours_rolling(
    df: DataFrame, days: int, as_of: datetime | None = None, ts: str = "created_at"
) -> DataFrame:
    """Rows of the last ``days`` times 24 hours, not aligned to midnight."""
    return time_range(df, now(as_of) - timedelta(days=positive("days", days)), ts=ts)


def one_day(df: DataFrame, day: datetime, ts: str = "created_at") -> DataFrame:
    """Rows of one calendar day as a half-open range."""
    start = day.replace(hour=0, minute=0, second=0, microsecond=0)
    return time_range(df, start, start + timedelta(days=1), ts=ts, hi_inclusive=False)
