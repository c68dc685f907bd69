"""Decimal money, ratios, sizes and their text forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"
# Totals keep 36 integer digits, so no volume of payments can overflow them.
TOTAL = "decimal(38,2)"

# Default conversion rates to USD; other currencies keep their amount.
USD_RATES = {"USD": "1", "EUR": "1.08", "GBP": "1.27"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_LOW_BITS = 20


def total(c) -> Column:
    """Exact sum of an amount column (other types are rounded to cents first).

    Spark adds wide decimals as big-number objects.  Cents fit a long, so their
    high and low bits are added as two longs, which the compiled aggregation
    keeps in registers and shuffles in half the space.  They hold totals up to
    9 * 10^22 over 8 * 10^12 rows per group; beyond that ANSI mode raises.
    """
    cents = (_col(c).cast(AMOUNT) * 100).cast("long")
    high = F.sum(F.shiftright(cents, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(cents.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    return ((high * (1 << _LOW_BITS) + low) * F.lit("0.01").cast("decimal(3,2)")).cast(TOTAL)


def ratio(numerator, denominator) -> Column:
    """Floating division that gives NULL on a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def mean(c) -> Column:
    """Average as exact sum over count, so partial sums do not change it."""
    return ratio(total(c), F.count(_col(c)))


def percent(part, whole, digits: int = 2) -> Column:
    p = _col(part).cast("double") * F.lit(100.0)
    return F.round(F.try_divide(p, _col(whole).cast("double")), digits)


def to_usd(amount, currency, rates: dict[str, str] | None = None) -> Column:
    """Amount times the rate of its currency, rounded half up to cents."""
    a, cur = _col(amount), _col(currency)
    result = a.cast(AMOUNT)
    for code, rate in (USD_RATES if rates is None else rates).items():
        if rate == "1":
            continue
        converted = (a * F.lit(rate).cast("decimal(10,4)")).cast(AMOUNT)
        result = F.when(cur == code, converted).otherwise(result)
    return result


def parse_amount(text, fallback: str = "0.00") -> Column:
    """Decimal from text; NULL and unparsable text give the fallback."""
    return F.coalesce(_col(text).cast("string").try_cast(AMOUNT), F.lit(fallback).cast(AMOUNT))


def dollars(c) -> Column:
    """``$1,234.56``; the sign of a negative amount follows the dollar sign."""
    return F.concat(F.lit("$"), F.format_number(_col(c).cast(TOTAL), 2))


def grouped(c) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(_col(c).cast("long"), 0)


def percent_text(c) -> Column:
    """One decimal place and a percent sign."""
    return F.concat(F.format_number(_col(c), 1), F.lit("%"))


def product(*factors) -> Column:
    """Product of longs as a double, whatever its size.

    It is exact up to 38 digits and rounded once; beyond that each step rounds.
    """
    kinds = ("decimal(20,0)", "double")
    return F.coalesce(
        *(reduce(F.try_multiply, [_col(f).cast(k) for f in factors]).cast("double") for k in kinds)
    )


def readable_size(bytes_) -> Column:
    """Bytes as text in powers of 1024 with two decimals."""
    b = _col(bytes_).cast("double")
    text = F.format_string("%.2f B", b)
    # Unit names in ascending order.
    for power, unit in enumerate(["KiB", "MiB", "GiB", "TiB", "PiB"], start=1):
        scale = float(1024**power)
        text = F.when(b >= scale, F.format_string(f"%.2f {unit}", b / scale)).otherwise(text)
    return text
