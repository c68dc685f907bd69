"""Joins of facts to dimensions.

A dimension is broadcast only after it has been measured: :func:`fits` sums the
bytes of the joined columns and compares them with a limit.  A larger dimension
is joined by shuffle, where AQE splits the skewed keys of the fact side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillflow.checks import one_of

BROADCAST_BYTES = 64 * 1024 * 1024


def fits(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows take at most ``max_bytes``, measured by one aggregation."""
    fixed = 16 * len(df.columns)
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    row_bytes = F.lit(fixed).cast("long")
    for name in strings:
        row_bytes = row_bytes + F.coalesce(F.octet_length(name), F.lit(0))
    measured = df.agg(F.sum(row_bytes)).first()[0]
    return (measured or 0) <= max_bytes


def enrich(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    columns: dict[str, str],
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add dimension columns (``{source: new name}``) to a fact.

    ``inner`` drops facts without a match, ``left`` keeps them with NULLs.
    With ``broadcast_bytes=0`` the dimension is not measured and Spark decides.
    """
    one_of("how", how, {"inner", "left"})
    dim = dimension.select(key, *[F.col(c).alias(n) for c, n in columns.items()])
    if broadcast_bytes and fits(dim, broadcast_bytes):
        dim = F.broadcast(dim)
    return fact.join(dim, key, how)


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    attribute: str,
    name: str,
    default=None,
) -> DataFrame:
    """Attribute of the matching dimension row, or the default."""
    joined = enrich(fact, dimension, key, {attribute: name}, "left")
    if default is None:
        return joined
    kind = dimension.schema[attribute].dataType
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(default).cast(kind)))


def first_seen(df: DataFrame, key: str, ts: str, period: Sequence) -> DataFrame:
    """One row per key and period with the key's first moment over all periods.

    Replaces the self-join of a fact with its per-key minimum: rows are reduced
    to (key, period) on the map side, and only those few rows are windowed.
    """
    per_period = df.groupBy(key, *period).agg(F.min(ts).alias("_first_in_period"))
    first = F.min("_first_in_period").over(Window.partitionBy(key))
    return per_period.withColumn("first_seen", first)
