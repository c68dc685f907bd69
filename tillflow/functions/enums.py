"""Enumerated columns: code to name, name to code, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payment status names and codes, in life-cycle order.
STATUS_CODES = {
    "pending": 1,
    "processing": 2,
    "completed": 3,
    "failed": 4,
    "refunded": 5,
    "cancelled": 6,
}
# States in which a payment has been processed.
TERMINAL_STATUSES = ("completed", "failed", "refunded")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _chain(value: Column, pairs) -> Column:
    result = F.lit(None)
    for key, mapped in reversed(list(pairs)):
        result = F.when(value == F.lit(key), F.lit(mapped)).otherwise(result)
    return result


def code_of(name, codes: dict[str, int] = STATUS_CODES) -> Column:
    """Code of a name (upper or lower case), NULL when unknown."""
    return _chain(F.lower(_col(name)), codes.items()).cast("int")


def name_of(code, codes: dict[str, int] = STATUS_CODES) -> Column:
    """Name of a code, NULL when unknown."""
    return _chain(_col(code), [(c, n) for n, c in codes.items()]).cast("string")


def coerce(value, codes: dict[str, int] = STATUS_CODES) -> Column:
    """Name from either a code or a name given as text, NULL when unknown."""
    text = _col(value).cast("string")
    by_code = name_of(text.try_cast("int"), codes)
    by_name = F.when(F.lower(text).isin(*codes), F.lower(text))
    return F.coalesce(by_code, by_name)


def require(value, codes: dict[str, int] = STATUS_CODES) -> Column:
    """As :func:`coerce`, but an unknown value fails the job."""
    name = coerce(value, codes)
    message = F.concat(
        F.lit("invalid value "),
        F.coalesce(_col(value).cast("string"), F.lit("NULL")),
        F.lit(", expected one of: " + ", ".join(codes)),
    )
    return F.when(name.isNotNull(), name).otherwise(F.raise_error(message).cast("string"))


def split_valid(df: DataFrame, column: str, codes: dict[str, int] = STATUS_CODES):
    """(rows with a known value, coerced; rows to quarantine, unchanged)."""
    name = coerce(column, codes)
    return (
        df.where(name.isNotNull()).withColumn(column, name),
        df.where(name.isNull()),
    )


def life_cycle_order(status) -> Column:
    """Sort key of the status life cycle; unknown values sort last."""
    return F.coalesce(code_of(status), F.lit(len(STATUS_CODES) + 1))
