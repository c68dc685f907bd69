"""Merge semantics of append-only tables: newest version, sums, cancellation.

Every operator reads the raw rows and returns what the table means; none needs
the table to have been compacted.  ``tillflow.sources.tables.compact`` applies
the same operators to stored partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    tiebreak: Sequence[str] = (),
    scope: Sequence[str] = (),
) -> DataFrame:
    """Row with the highest version of every key.

    ``scope`` adds columns within which versions replace each other, e.g. the
    storage partition.  ``row_number() = 1`` is trimmed inside each map task
    (WindowGroupLimit), so a hot key sends one row per task to the reducer.
    """
    newest = [F.col(c).desc() for c in (version, *tiebreak)]
    w = Window.partitionBy(*keys, *scope).orderBy(*newest)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def last_insert(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Last inserted row of every key by an ingest sequence column."""
    return latest_version(df, keys, sequence)


def current_state(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    deleted: str = "is_deleted",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Newest change of every key, without the keys that were deleted."""
    return latest_version(df, keys, version, tiebreak).where(~F.col(deleted).cast("boolean"))


def latest_values(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Selected columns at the highest version, as one aggregation."""
    newest = F.max_by(F.struct(*columns), F.struct(*version)).alias("_v")
    return df.groupBy(*keys).agg(newest).select(*keys, *[f"_v.{c}" for c in columns])


def summing(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Sum every numeric non-key column (or the named ones) per key."""
    if columns is None:
        columns = [
            f.name
            for f in df.schema.fields
            if f.name not in keys and isinstance(f.dataType, NumericType)
        ]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


#: Copies of a row that :func:`collapse` makes at a time.
BLOCK = 4096


def _net(df: DataFrame, sign: str) -> DataFrame:
    payload = [c for c in df.columns if c != sign]
    return df.groupBy(*payload).agg(F.sum(sign).alias("_net"))


def collapse(df: DataFrame, sign: str = "sign") -> DataFrame:
    """Rows left after each -1 row cancels an equal +1 row.

    Equality covers all other columns, a version column included, so rows may
    arrive in any order.  A row that is left over several times comes as often; copies are
    made in blocks of ``BLOCK``, so that no array holds them all.
    """
    net = _net(df, sign).where("_net > 0")
    blocks = net.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_net - 1) div {BLOCK})")))
    size = F.least(F.lit(BLOCK), F.col("_net") - F.col("_block") * BLOCK).cast("int")
    copies = F.explode(F.array_repeat(F.lit(1), size))
    return blocks.withColumn(sign, copies).drop("_net", "_block")


def unmatched_cancels(df: DataFrame, sign: str = "sign") -> DataFrame:
    """Cancelling rows that never met their row, with how many are missing."""
    return _net(df, sign).where("_net < 0").withColumn("missing", -F.col("_net")).drop("_net")
