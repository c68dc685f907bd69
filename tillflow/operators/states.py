"""Mergeable aggregate states.

A measure owns one or more plain state columns.  ``build_states`` fills them
from rows, ``merge_states`` combines rows of states into fewer rows of states
at any coarser key, ``read_states`` turns merged states into results.  All
three are ordinary grouped aggregations and combine on the map side.

Distinct counts and quantiles come in two kinds.  Sketches (``distinct_of``, ``quantile_of``)
are columns like the others, exact for few values and estimates beyond.  The exact kind
(``exact_distinct_of``, ``exact_quantile_of``) is exact for groups of any size: beside the row
of a group there are rows of its parts, one for each slot, so that no group is ever gathered
in one row.  A slot is a range of 32,768 ids with a bitmap, or a value with its count; merging
is a bitwise or, or a sum.  Rows of parts have a name in ``_part`` and null in other states.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.money import TOTAL, ratio
from tillflow.functions.money import total as money_total
from tillflow.operators.quantiles import label, quantiles_of_counts

HLL_LG_K = 12
KLL_K = 200


# Columns are made by functions, so that measures can be declared at import time,
# before there is a session.


@dataclass(frozen=True)
class StateColumn:
    name: str
    build: Callable[[], Column]
    merge: Callable[[str], Column]


@dataclass(frozen=True)
class Part:
    """Rows of slots that hold an exact state: of bitmaps, or of values with counts."""

    name: str
    source: str
    bitmaps: bool
    cents: bool = False

    def slot(self) -> Column:
        if self.bitmaps:
            return F.bitmap_bucket_number(self.source)
        return (F.col(self.source) * 100 if self.cents else F.col(self.source)).cast("long")


@dataclass(frozen=True)
class Measure:
    name: str
    states: tuple[StateColumn, ...]
    result: Callable[[], Column] | None
    part: Part | None = None
    quantile: float | None = None


#: Columns of the rows of parts.
PART_COLUMNS = {"_part": "string", "_slot": "long", "_bits": "binary", "_n": "long"}


def _sum_state(name: str, source: str) -> StateColumn:
    return StateColumn(
        name, lambda: money_total(source), lambda c: F.sum(c).cast(TOTAL)
    )


def _count_state(name: str) -> StateColumn:
    return StateColumn(name, lambda: F.count("*"), F.sum)


def sum_of(name: str, source: str = "amount") -> Measure:
    return Measure(name, (_sum_state(name, source),), lambda: F.col(name))


def count_of(name: str) -> Measure:
    return Measure(name, (_count_state(name),), lambda: F.col(name))


def mean_of(name: str, source: str = "amount") -> Measure:
    """Sum and count of the non-null values; averages themselves do not merge."""
    s, n = f"{name}_sum", f"{name}_count"
    counted = StateColumn(n, lambda: F.count(source), F.sum)
    return Measure(name, (_sum_state(s, source), counted), lambda: ratio(s, n))


def min_of(name: str, source: str = "amount") -> Measure:
    return Measure(name, (StateColumn(name, lambda: F.min(source), F.min),), lambda: F.col(name))


def max_of(name: str, source: str = "amount") -> Measure:
    return Measure(name, (StateColumn(name, lambda: F.max(source), F.max),), lambda: F.col(name))


def distinct_of(name: str, source: str, lg_k: int = HLL_LG_K) -> Measure:
    """Distinct count by a mergeable HLL sketch; ``lg_k`` trades size for error."""
    sketch = StateColumn(
        f"{name}_hll", lambda: F.hll_sketch_agg(source, lg_k), lambda c: F.hll_union_agg(c)
    )
    return Measure(name, (sketch,), lambda: F.hll_sketch_estimate(f"{name}_hll"))


def quantile_of(name: str, p: float, source: str = "amount", k: int = KLL_K) -> Measure:
    """Quantile by a mergeable KLL sketch; all quantiles of a source share one."""
    column = f"{source}_kll"
    sketch = StateColumn(
        column,
        lambda: F.kll_sketch_agg_double(F.col(source).cast("double"), k),
        lambda c: F.kll_merge_agg_double(c, k),
    )
    return Measure(name, (sketch,), lambda: F.kll_sketch_get_quantile_double(column, F.lit(p)))


def exact_distinct_of(name: str, source: str, dense: bool = False) -> Measure:
    """Distinct count of whole numbers, exact at any size.

    ``dense`` keeps bitmaps: right for groups with many of the ids there are, as each range of
    32,768 ids takes 4 KB.  Without it each value is a row, right for many small groups.
    """
    part = Part(f"{source}:{'bits' if dense else 'values'}", source, dense)
    return Measure(name, (), None, part)


def exact_quantile_of(name: str, p: float, source: str = "amount") -> Measure:
    """The least amount that a share ``p`` of the group's amounts doesn't exceed, exactly."""
    return Measure(name, (), None, Part(f"{source}:cents", source, False, True), p)


#: Items that a top-k state tracks.
TRACKED = 1000


def top_of(name: str, source: str, tracked: int = TRACKED) -> Measure:
    """The most frequent value by a mergeable sketch: value, count and the counts' error bound.

    The smallest of equally frequent values wins.  A sketch that tracks up to M items is off by
    at most 3.5 / M of all rows of the group; with an error of 0 the result is exact.
    """
    state, n = f"{name}_topk", f"{name}_rows"
    size = 1 << (math.ceil(tracked / 0.75) - 1).bit_length()
    build = StateColumn(
        state,
        lambda: F.expr(f"approx_top_k_accumulate(`{source}`, {tracked})"),
        lambda c: F.expr(f"approx_top_k_combine(`{c}`, {tracked})"),
    )
    counted = StateColumn(n, lambda: F.count(source), F.sum)

    def result() -> Column:
        items = F.expr(f"approx_top_k_estimate(`{state}`, {tracked})")
        best = F.array_min(F.transform(items, lambda x: F.struct((-x["count"]).alias("less"), x["item"].alias("item"))))
        error = F.floor(F.col(n) * 3.5 / size).cast("long")
        return F.struct(best["item"].alias("value"), (-best["less"]).alias("count"), error.alias("error"))

    return Measure(name, (build, counted), result)


def _columns(measures: Sequence[Measure]) -> list[StateColumn]:
    unique: dict[str, StateColumn] = {}
    for m in measures:
        for s in m.states:
            unique.setdefault(s.name, s)
    return list(unique.values())


def _parts(measures: Sequence[Measure]) -> list[Part]:
    return list({m.part.name: m.part for m in measures if m.part}.values())


def state_names(measures: Sequence[Measure]) -> list[str]:
    return [s.name for s in _columns(measures)]


def build_states(df: DataFrame, keys: Sequence, measures: Sequence[Measure]) -> DataFrame:
    """Rows to one row of states per key; keys may be names or columns.

    With exact measures the rows of their parts follow.
    """
    return _joined(_grouped(df, keys, [s.build().alias(s.name) for s in _columns(measures)]), [
        _filled(df, keys, part) for part in _parts(measures)
    ])


def _grouped(df: DataFrame, keys: Sequence, columns: list[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*columns) if columns else df.select(*keys).distinct()


def _filled(df: DataFrame, keys: Sequence, part: Part) -> DataFrame:
    grouped = df.where(F.col(part.source).isNotNull()).groupBy(*keys, part.slot().alias("_slot"))
    if part.bitmaps:
        out = grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position(part.source)).alias("_bits"))
    else:
        out = grouped.agg(F.count("*").alias("_n"))
    return out.withColumn("_part", F.lit(part.name))


def _joined(plain: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """State rows and rows of parts in one table, with the same columns whatever parts there are."""
    if not parts:
        return plain
    out = plain.withColumns({c: F.lit(None).cast(kind) for c, kind in PART_COLUMNS.items()})
    for part in parts:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _merged(df: DataFrame, keys: Sequence, measures: Sequence[Measure]) -> tuple[DataFrame, list[DataFrame]]:
    """Merged states, and the merged rows of each wanted kind of parts."""
    has_parts = "_part" in df.columns
    plain = df.where("_part IS NULL") if has_parts else df
    plain = _grouped(plain, keys, [s.merge(s.name).alias(s.name) for s in _columns(measures)])
    out = []
    for bitmaps in (True, False):
        names = [p.name for p in _parts(measures) if p.bitmaps == bitmaps]
        if not names:
            continue
        if not has_parts:
            raise ValueError(f"these states have no rows for {names}")
        slots = df.where(F.col("_part").isin(names)).groupBy(*keys, "_part", "_slot")
        merged = F.bitmap_or_agg("_bits").alias("_bits") if bitmaps else F.sum("_n").alias("_n")
        out.append(slots.agg(merged))
    return plain, out


def merge_states(df: DataFrame, keys: Sequence, measures: Sequence[Measure]) -> DataFrame:
    """States to states at the given (same or coarser) keys."""
    return _joined(*_merged(df, keys, measures))


def read_states(df: DataFrame, keys: Sequence, measures: Sequence[Measure]) -> DataFrame:
    """Merge and turn into results."""
    plain, parts = _merged(df, keys, measures)
    names = [c for c in plain.columns if c not in set(state_names(measures))]
    out = plain.select(*names, *[m.result().alias(m.name) for m in measures if m.result])
    if not parts:
        return out
    for rows in parts:
        out = out.unionByName(_counted(rows, names, measures), allowMissingColumns=True)
        for name in {m.part.name for m in measures if m.quantile is not None and "_n" in rows.columns}:
            found = _quantiles(rows.where(F.col("_part") == name), names, name, measures)
            out = out.unionByName(found, allowMissingColumns=True)
    none = {m.name for m in measures if m.part and m.quantile is None}
    one = [F.max(m.name) if m.name not in none else F.coalesce(F.max(m.name), F.lit(0)) for m in measures]
    return out.groupBy(*names).agg(*[c.cast(_kind(m, plain)).alias(m.name) for c, m in zip(one, measures)])


def _kind(m: Measure, plain: DataFrame) -> str:
    if m.result:
        return plain.select(m.result().alias("x")).schema["x"].dataType.simpleString()
    return "long" if m.quantile is None else "double"


def _counted(rows: DataFrame, keys: list[str], measures: Sequence[Measure]) -> DataFrame:
    """Distinct counts from merged rows of parts."""
    size = F.bitmap_count("_bits") if "_bits" in rows.columns else F.lit(1)
    wanted = [m for m in measures if m.part and m.quantile is None and m.part.bitmaps == ("_bits" in rows.columns)]
    of = [F.sum(F.when(F.col("_part") == m.part.name, size)).alias(m.name) for m in wanted]
    return _grouped(rows, keys, of)


def _quantiles(rows: DataFrame, keys: list[str], part: str, measures: Sequence[Measure]) -> DataFrame:
    wanted = [m for m in measures if m.quantile is not None and m.part.name == part]
    counts = rows.select(*keys, F.col("_slot").alias("_c"), "_n")
    found = quantiles_of_counts(counts, keys, sorted({m.quantile for m in wanted}), interpolate=False)
    return found.select(*keys, *[F.col(label(m.quantile)).alias(m.name) for m in wanted])
