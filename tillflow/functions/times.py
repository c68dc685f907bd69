"""Calendar functions over timestamps and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(ts) -> Column:
    return F.to_date(_col(ts))


def hour_of_day(ts) -> Column:
    return F.hour(_col(ts)).cast("int")


def hour_start(ts) -> Column:
    """The full hour, without a time zone (``date_trunc`` alone returns one)."""
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def month_start(ts) -> Column:
    return F.trunc(_col(ts), "month")


def iso_weekday(ts) -> Column:
    """Monday = 1 … Sunday = 7."""
    return (F.weekday(_col(ts)) + F.lit(1)).cast("int")


def is_weekend(ts) -> Column:
    return F.when(iso_weekday(ts) >= 6, F.lit(1)).otherwise(F.lit(0))


def week_start(ts, first_day: str = "sunday") -> Column:
    """First day of the week, Sunday unless ``first_day='monday'``."""
    d = day(ts)
    if first_day == "monday":
        return F.date_sub(d, F.weekday(d))
    if first_day == "sunday":
        return F.date_sub(d, F.dayofweek(d) - F.lit(1))
    raise ValueError(f"first_day must be 'sunday' or 'monday', got {first_day!r}")


def yyyymm(ts) -> Column:
    c = _col(ts)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def yyyymmdd(ts) -> Column:
    c = _col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def days_between(start, end) -> Column:
    """Number of midnights between two moments (calendar days)."""
    return F.datediff(day(end), day(start)).cast("int")


def months_between_grid(start, end) -> Column:
    """Difference of calendar months, whatever the day of the month."""
    s, e = _col(start), _col(end)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("int")


def whole_days_between(start, end) -> Column:
    """Number of complete 24-hour periods between two moments."""
    seconds = F.timestamp_diff("SECOND", _col(start), _col(end))
    return F.floor(seconds / F.lit(86400)).cast("int")


def plus(ts, *, years=0, months=0, days=0, hours=0, seconds=0) -> Column:
    """Timestamp shifted by a calendar interval."""
    interval = F.make_interval(
        F.lit(years), F.lit(months), F.lit(0), F.lit(days), F.lit(hours), F.lit(0), F.lit(seconds)
    )
    return (_col(ts) + interval).cast("timestamp_ntz")


def to_text(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss")


def hour_text(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd HH:00")
