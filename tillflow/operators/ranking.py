"""Top-k, ranks and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.checks import not_negative, positive


def top(df: DataFrame, order: list[Column], n: int, offset: int = 0) -> DataFrame:
    """First ``n`` rows of an order after skipping ``offset`` (one bounded heap
    per task, no full sort)."""
    ordered = df.orderBy(*order)
    if not_negative("offset", offset):
        ordered = ordered.offset(offset)
    return ordered.limit(positive("limit", n))


def top_ranked(df: DataFrame, order: list[Column], n: int, rank: str) -> DataFrame:
    """Top ``n`` rows numbered from 1.

    Only the ``n`` selected rows meet in one task: the limit comes first and
    the numbering second, which gives the same numbers as ranking everything.
    """
    best = top(df, order, n)
    number = F.row_number().over(Window.orderBy(*order)).cast("long")
    return best.withColumn(rank, number).orderBy(rank)


def top_per_group(
    df: DataFrame, groups: list[str], order: list[Column], n: int, rank: str
) -> DataFrame:
    """Top ``n`` rows of each group, numbered from 1.

    Spark trims every group to ``n`` rows inside each map task before the
    shuffle (WindowGroupLimit), so one large group is not gathered anywhere.
    """
    w = Window.partitionBy(*groups).orderBy(*order)
    # The cast follows the filter: the trim needs the bare rank in the condition.
    kept = df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= positive("n", n))
    return kept.withColumn(rank, F.col(rank).cast("long"))


def grand_total(column: str) -> Column:
    """Total over an already aggregated, small result (a row per category,
    status or day); never use it on raw rows."""
    return F.sum(column).over(Window.partitionBy())


def distinct(column: str, approx: bool = False) -> Column:
    """Distinct count, exact or by sketch; Spark spreads the exact form over
    (group, value) before it counts, so a hot group stays distributed."""
    counted = F.approx_count_distinct(column) if approx else F.count_distinct(F.col(column))
    return counted.cast("long")


def most_frequent(df: DataFrame, groups: list[str], column: str, name: str) -> DataFrame:
    """Most frequent value per group; the smallest value wins a tie."""
    counts = df.groupBy(*groups, column).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("_n"), F.col(column).alias("_v")))
    return (
        counts.groupBy(*groups)
        .agg(best.alias("_best"))
        .select(
            *groups,
            F.col("_best._v").alias(name),
            (-F.col("_best._n")).alias(f"{name}_count"),
        )
    )
