"""Exact quantiles of decimal amounts without gathering a group.

Spark's ``percentile`` keeps every distinct value of a group in one buffer.
Here values are first counted (map-side combined), located in coarse ranges
of 2^20 cents, and only the ranges that hold a wanted rank are looked at in
detail, so the rows ordered together are bounded by the width of a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 20


def label(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def exact_quantiles(
    df: DataFrame, keys: list[str], amount: str, probabilities: list[float]
) -> DataFrame:
    """One row per key with ``p50``-style columns, linearly interpolated."""
    cents = (F.col(amount) * 100).cast("long").alias("_c")
    counted = (
        df.where(F.col(amount).isNotNull())
        .select(*keys, cents)
        .groupBy(*keys, "_c")
        .agg(F.count("*").alias("_n"))
    )
    return quantiles_of_counts(counted, keys, probabilities)


def quantiles_of_counts(
    counts: DataFrame, keys: list[str], probabilities: list[float], interpolate: bool = True
) -> DataFrame:
    """Quantiles from how often each amount occurs: ``counts`` has the keys, _c (cents) and _n.

    Without ``interpolate`` a quantile is the least amount that the share doesn't exceed.
    """
    counted = counts.withColumn("_range", F.shiftright("_c", RANGE_BITS))
    by_range = Window.partitionBy(*keys).orderBy("_range")
    ranges = (
        counted.groupBy(*keys, "_range")
        .agg(F.sum("_n").alias("_rn"))
        .withColumn("_end", F.sum("_rn").over(by_range))
        .withColumn("_total", F.sum("_rn").over(Window.partitionBy(*keys)))
        .withColumn("_start", F.col("_end") - F.col("_rn"))
    )

    def position(p: float) -> Column:
        if interpolate:
            return F.lit(float(p)) * (F.col("_total") - 1)
        return F.greatest(F.ceil(F.lit(float(p)) * F.col("_total")), F.lit(1)) - F.lit(1)

    def rank_low(p: float) -> Column:
        return F.floor(position(p))

    def rank_high(p: float) -> Column:
        return F.ceil(position(p))

    wanted = [f(p) for p in probabilities for f in (rank_low, rank_high)]
    hit = F.lit(False)
    for r in wanted:
        hit = hit | ((r >= F.col("_start")) & (r < F.col("_end")))
    names = {k: f"_k{i}" for i, k in enumerate([*keys, "_range"])}
    selected = ranges.where(hit).select(
        *[F.col(k).alias(n) for k, n in names.items()], "_start", "_total"
    )
    # A null-safe join adds no IS NOT NULL filter to one side, so both sides
    # keep the same plan below and the counts are shuffled (and scanned) once.
    same_range = F.lit(True)
    for key, name in names.items():
        same_range = same_range & F.col(key).eqNullSafe(F.col(name))

    inside = Window.partitionBy(*keys, "_range").orderBy("_c")
    detail = (
        counted.join(selected, same_range)
        .withColumn("_to", F.col("_start") + F.sum("_n").over(inside))
        .withColumn("_from", F.col("_to") - F.col("_n"))
    )

    def value_at(rank: Column) -> Column:
        here = (rank >= F.col("_from")) & (rank < F.col("_to"))
        return F.max(F.when(here, F.col("_c"))) / F.lit(100.0)

    aggregates = [F.first("_total").alias("_total")]
    for p in probabilities:
        aggregates += [
            value_at(rank_low(p)).alias(f"_lo_{label(p)}"),
            value_at(rank_high(p)).alias(f"_hi_{label(p)}"),
        ]
    found = detail.groupBy(*keys).agg(*aggregates)

    def between(p: float) -> Column:
        share = position(p) - rank_low(p)
        lo, hi = F.col(f"_lo_{label(p)}"), F.col(f"_hi_{label(p)}")
        return (lo * (1.0 - share) + hi * share).alias(label(p))

    return found.select(*keys, *[between(p) for p in probabilities])


def sketch_quantiles(
    df: DataFrame, keys: list[str], amount: str, probabilities: list[float]
) -> DataFrame:
    """Approximate quantiles, one pass with a bounded buffer per group."""
    values = F.percentile_approx(F.col(amount).cast("double"), list(probabilities), 10000)
    out = df.groupBy(*keys).agg(values.alias("_q"))
    return out.select(
        *keys, *[F.col("_q")[i].alias(label(p)) for i, p in enumerate(probabilities)]
    )
