"""Arguments, empty inputs, invariants and shapes of the analytical plans."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.operators import joins
from tillflow.plans import customers, merchants, reports, revenue, segments
from tillflow.registry.analytics import AS_OF
from tillflow.sources import views


@pytest.fixture
def txn(spark, sf_dir):
    return views.txn(spark, sf_dir)


@pytest.mark.parametrize(
    "call, name",
    [
        (lambda t: customers.payments_of(t, 0), "user_id"),
        (lambda t: customers.payments_of(t, 1, limit=0), "limit"),
        (lambda t: customers.payments_of(t, 1, offset=-1), "offset"),
        (lambda t: customers.spending_summary(t, 0), "user_id"),
        (lambda t: revenue.merchant_revenue(t, limit=0), "limit"),
        (lambda t: revenue.top_merchants(t, limit=0), "limit"),
        (lambda t: revenue.top_merchants(t, days=0), "days"),
        (lambda t: revenue.daily_revenue(t, days=0), "days"),
        (lambda t: revenue.hourly_stats(t, days=0), "days"),
        (lambda t: segments.category_breakdown(t, days=0), "days"),
        (lambda t: segments.status_distribution(t, days=0), "days"),
    ],
)
def test_arguments_are_checked_before_planning(call, name):
    with pytest.raises(ValueError, match=name):
        call(None)


def test_unknown_user(txn):
    (r,) = customers.spending_summary(txn, 10**9).collect()
    assert (r.total_transactions, r.total_spent, r.avg_transaction) == (0, Decimal("0.00"), 0.0)
    assert r.first_transaction is None and r.last_transaction is None
    assert (r.days_active, r.merchants_used, r.categories_used) == (0, 0, 0)
    assert r.favorite_category is None and r.favorite_merchant == 0
    (text,) = reports.user(txn, 10**9).collect()
    assert text.total_spent == "$0.00" and text.favorite_category == "N/A"


def test_empty_table(txn):
    (r,) = revenue.total_stats(txn.where("false")).collect()
    assert tuple(r) == (0, Decimal("0.00"), 0, 0, None, None)
    assert revenue.daily_revenue(txn.where("false"), as_of=AS_OF).count() == 0


def test_default_moment_is_now(spark, txn):
    assert revenue.daily_revenue(txn, 1).count() == 0
    recent = txn.withColumn("created_at", F.localtimestamp())
    assert revenue.daily_revenue(recent, 1).count() == 1


def test_limits_are_respected_and_ranked(txn):
    rows = revenue.top_merchants(txn, 3, 30, AS_OF).collect()
    assert [r.revenue_rank for r in rows] == [1, 2, 3]
    totals = [r.total_revenue for r in rows]
    assert totals == sorted(totals, reverse=True)


def test_pages_do_not_overlap(txn):
    user = txn.groupBy("user_id").count().orderBy(F.desc("count")).first().user_id
    pages = [
        [r.transaction_id for r in customers.payments_of(txn, user, 3, o).collect()] for o in (0, 3)
    ]
    both = [r.transaction_id for r in customers.payments_of(txn, user, 6).collect()]
    assert pages[0] + pages[1] == both


def test_shares_add_up(txn):
    rows = segments.category_performance(txn, 30, AS_OF).collect()
    assert abs(sum(r.revenue_share_pct for r in rows) - 100) < 0.1
    failures = segments.failed_analysis(txn, 7, AS_OF).collect()
    assert abs(sum(r.pct_of_failures for r in failures) - 100) < 1


def test_full_report_sections(txn):
    sections = reports.full(txn, 30, AS_OF)
    assert list(sections) == ["summary", "revenue", "merchants", "categories", "statuses"]
    lines = sections["revenue"].collect()
    assert lines[-1].date == "Total" and len(lines) == 15
    assert all(s.count() for s in sections.values())


def test_approximate_counts_are_close(txn):
    exact = revenue.total_stats(txn).first()
    close = revenue.total_stats(txn, approx=True).first()
    assert abs(close.total_users - exact.total_users) <= 0.1 * exact.total_users


def test_whole_cohort_is_counted_once(spark):
    rows = [(1, datetime(2024, 1, 31)), (1, datetime(2024, 2, 1)), (1, datetime(2024, 2, 2)),
            (2, datetime(2024, 2, 9))]
    df = spark.createDataFrame(rows, "user_id long, created_at timestamp_ntz")
    got = [(str(r[0]), r[1], r[2]) for r in customers.cohort_retention(df).collect()]
    assert got == [("2024-01-01", 0, 1), ("2024-01-01", 1, 1), ("2024-02-01", 0, 1)]


# -- shapes of the physical plans -------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_look_back_reaches_the_scan(txn):
    plan = plan_of(revenue.daily_revenue(txn, 7, AS_OF))
    assert "GreaterThanOrEqual(ts,2024-01-24" in plan
    assert "event_type" not in plan.split("ReadSchema")[1]


def test_user_lookup_reaches_the_scan(txn):
    assert "EqualTo(user_id,42)" in plan_of(customers.payments_of(txn, 42))


def test_top_k_does_not_sort_everything(txn):
    plan = plan_of(revenue.merchant_leaders(txn, 10))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_groups_are_trimmed_before_the_shuffle(txn):
    assert plan_of(customers.top_spenders(txn, 5, 30, AS_OF)).count("WindowGroupLimit") == 2


def test_cohorts_need_no_self_join(spark, sf_dir):
    events_only = customers.cohort_retention(views.txn(spark, sf_dir))
    assert "Join" not in plan_of(events_only)


def test_dimension_is_broadcast_only_when_it_fits(spark, sf_dir, txn):
    names = views.merchants(spark, sf_dir)
    small = merchants.with_names(txn, names)
    assert "BroadcastHashJoin [merchant_id" in plan_of(small)
    columns = {"name": "merchant_name"}
    large = joins.enrich(txn, names, "merchant_id", columns, "inner", broadcast_bytes=100)
    assert not joins.fits(names, 100) and joins.fits(names)
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert large.count() == small.count()


def test_lookup_default(spark, txn):
    rates = views.currency_rates(spark)
    got = merchants.in_usd(txn, rates).where("currency = 'JPY' and amount <> amount_usd")
    assert got.count() == 0
