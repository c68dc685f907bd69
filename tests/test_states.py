from __future__ import annotations

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.operators.quantiles import exact_quantiles, sketch_quantiles
from tillflow.operators.states import (
    build_states, count_of, distinct_of, exact_distinct_of, exact_quantile_of, max_of, mean_of, merge_states, min_of, quantile_of,
    read_states, state_names, sum_of, top_of,
)

MEASURES = [
    sum_of("total"), count_of("n"), mean_of("avg"), min_of("lo"), max_of("hi"),
    distinct_of("users", "user_id"), quantile_of("p50", 0.5),
]


def amounts(spark, rows):
    df = spark.createDataFrame(rows, "k string, user_id long, a string")
    return df.select("k", "user_id", F.col("a").cast("decimal(18,2)").alias("amount"))


def test_partial_sums_add_up(spark):
    first = build_states(amounts(spark, [("x", 1, "100"), ("x", 2, "200"), ("x", 3, "150")]),
                         ["k"], [sum_of("total")])
    second = build_states(amounts(spark, [("x", 1, "300"), ("x", 2, "250")]), ["k"], [sum_of("total")])
    assert first.first().total == Decimal("450.00")
    assert second.first().total == Decimal("550.00")
    merged = read_states(first.unionByName(second), ["k"], [sum_of("total")])
    assert merged.first().total == Decimal("1000.00")


def test_average_of_unequal_parts(spark):
    a = build_states(amounts(spark, [("x", 1, "10")]), ["k"], [mean_of("avg")])
    b = build_states(amounts(spark, [("x", 1, "1"), ("x", 1, "1"), ("x", 1, "0")]), ["k"], [mean_of("avg")])
    assert read_states(a.unionByName(b), ["k"], [mean_of("avg")]).first().avg == 3.0


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_any_split_gives_the_same_result(spark, parts):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randint(1, 9), f"{rng.randint(1, 9999) / 100:.2f}") for _ in range(300)]
    whole = amounts(spark, rows)
    expected = sorted(map(tuple, read_states(build_states(whole, ["k"], MEASURES), ["k"], MEASURES).collect()))
    states = None
    for i in range(parts):
        part = build_states(amounts(spark, rows[i::parts]), ["k"], MEASURES)
        states = part if states is None else states.unionByName(part)
    halfway = merge_states(states, ["k"], MEASURES)
    got = sorted(map(tuple, read_states(halfway, ["k"], MEASURES).collect()))
    plain = [(r[0], *r[1:6]) for r in got]
    assert plain == [(r[0], *r[1:6]) for r in expected]
    assert [r[6] for r in got] == [r[6] for r in expected]


def test_quantiles_share_one_sketch():
    names = state_names([quantile_of("p50", 0.5), quantile_of("p99", 0.99), mean_of("avg")])
    assert names == ["amount_kll", "avg_sum", "avg_count"]


def test_sketch_errors(spark):
    n = 50_000
    df = spark.range(n).select(
        F.lit("x").alias("k"), F.col("id").alias("user_id"),
        (F.xxhash64("id") % 100000).cast("decimal(18,2)").alias("amount"),
        (F.col("id") % 20).alias("part"),
    )
    wanted = [distinct_of("users", "user_id"), quantile_of("p50", 0.5), quantile_of("p95", 0.95)]
    row = read_states(build_states(df, ["k", "part"], wanted), ["k"], wanted).first()
    assert abs(row.users - n) / n < 0.05
    values = np.sort(np.array([float(r[0]) for r in df.select("amount").collect()]))
    for p, estimate in ((0.5, row.p50), (0.95, row.p95)):
        rank = np.searchsorted(values, estimate) / n
        assert abs(rank - p) < 0.02


@pytest.mark.parametrize("seed", range(4))
def test_exact_quantiles_match_numpy(spark, seed):
    rng = random.Random(seed)
    # Wide values: several coarse ranges, negative amounts, one hot value.
    rows = []
    for k in "abc":
        for _ in range(rng.randint(1, 200)):
            cents = rng.choice([rng.randint(-50, 50), rng.randint(0, 10**9), 777])
            rows.append((k, 1, f"{Decimal(cents) / 100:.2f}"))
    probabilities = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = exact_quantiles(amounts(spark, rows), ["k"], "amount", probabilities).collect()
    assert len(got) == 3
    for r in got:
        values = np.array([float(a) for k, _, a in rows if k == r.k])
        expected = np.quantile(values, probabilities)
        assert np.allclose([r.p0, r.p25, r.p50, r.p95, r.p100], expected)


def test_exact_quantiles_scan_once_and_keep_null_keys(spark):
    df = amounts(spark, [(None, 1, "1"), (None, 1, "3"), ("a", 1, "5")])
    out = exact_quantiles(df, ["k"], "amount", [0.5])
    assert {r.k: r.p50 for r in out.collect()} == {None: 2.0, "a": 5.0}
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_sketch_quantiles(spark):
    df = amounts(spark, [("a", 1, str(i)) for i in range(1, 101)])
    (row,) = sketch_quantiles(df, ["k"], "amount", [0.5, 0.99]).collect()
    assert row.p50 == 50.0 and row.p99 == 99.0


EXACT = [
    sum_of("total"), exact_distinct_of("bits", "user_id", dense=True), exact_distinct_of("values", "user_id"),
    exact_quantile_of("p50", 0.5), exact_quantile_of("p99", 0.99),
]


def plain_exact(rows):
    out = []
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        users = len({r[1] for r in own if r[1] is not None})
        cents = sorted(round(100 * float(r[2])) for r in own if r[2] is not None)
        at = lambda p: cents[max(int(np.ceil(p * len(cents))), 1) - 1] / 100 if cents else None
        total = Decimal(sum(cents)) / 100 if cents else None
        out.append((k, total, users, users, at(0.5), at(0.99)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 4])
def test_exact_states_of_any_split(spark, parts):
    rng = random.Random(4)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice([None, -5, 2**40, rng.randint(0, 70_000)]),
         rng.choice([None, "-3.10", f"{rng.randint(1, 10**8) / 100:.2f}"]))
        for _ in range(400)
    ] + [("none", None, None)]
    states = None
    for i in range(parts):
        part = build_states(amounts(spark, rows[i::parts]), ["k"], EXACT)
        states = part if states is None else states.unionByName(part)
    halfway = merge_states(states, ["k"], EXACT)
    assert halfway.columns == states.columns
    got = [(r[0], r[1], *r[2:]) for r in map(tuple, read_states(halfway, ["k"], EXACT).collect())]
    assert sorted(got, key=repr) == plain_exact(rows)
    only = read_states(halfway, ["k"], EXACT[2:3]).collect()
    assert sorted((tuple(r) for r in only), key=repr) == sorted(((r[0], r[2]) for r in plain_exact(rows)), key=repr)


def test_exact_states_of_large_groups(spark):
    """Sketches are estimates at this size; these are not."""
    n = 120_000
    rows = spark.range(2 * n).select(
        F.lit("x").alias("k"), (F.col("id") % n * 3).alias("user_id"),
        ((F.col("id") * 7919) % 1_000_003 / 100).cast("decimal(18,2)").alias("amount"), (F.col("id") % 5).alias("day"),
    )
    days = build_states(rows, ["k", "day"], EXACT)
    got = read_states(days, ["k"], EXACT).first()
    cents = sorted(i * 7919 % 1_000_003 for i in range(2 * n))
    assert (got.bits, got["values"]) == (n, n)
    assert (got.p50, got.p99) == tuple(cents[int(np.ceil(p * 2 * n)) - 1] / 100 for p in (0.5, 0.99))
    with pytest.raises(ValueError, match="no rows"):
        read_states(build_states(rows, ["k"], EXACT[:1]), ["k"], EXACT)


def test_top_states_merge_and_bound_their_error(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 2).alias("k"), F.expr("id % 6").alias("day"),
        F.when(F.col("id") % 10 < 4, F.lit("b")).when(F.col("id") % 10 < 8, F.lit("a"))
        .otherwise(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("c"),
    )
    measure = [top_of("best", "c", 50)]
    merged = read_states(build_states(rows, ["k", "day"], measure), ["k"], measure)
    got = {r.k: r.best for r in merged.collect()}
    for k, best in got.items():
        true = {r.c: r["count"] for r in rows.where(f"k = {k} AND c IN ('a', 'b')").groupBy("c").count().collect()}
        assert best.value in true and 0 < best.error < 30_000
        assert abs(best["count"] - true[best.value]) <= best.error
    small = read_states(build_states(rows.where("id < 40"), ["k", "day"], measure), ["k"], measure).collect()
    assert {(r.k, *r.best) for r in small} == {(0, "a", 8, 0), (1, "a", 8, 0)}
