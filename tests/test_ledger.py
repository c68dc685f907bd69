"""The everyday object, from an empty table to reports."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from tillflow.ledger import Ledger
from tillflow.sources.generator import Generator

END = datetime(2024, 3, 31)


@pytest.fixture(scope="module")
def ledger(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS till_ledger")
    made = Ledger(spark, "till_ledger", as_of=END)
    made.create()
    yield made
    spark.sql("DROP DATABASE till_ledger CASCADE")


def test_empty_ledger(ledger):
    assert ledger.insert_batch([]) == 0
    assert tuple(ledger.total_stats().first()) == (0, Decimal("0.00"), 0, 0, None, None)
    assert ledger.spending_summary(1).first().total_transactions == 0


def test_loaded_ledger_answers_everything(spark, ledger):
    rows = Generator(users=20, merchants=5, days=60, seed=3, as_of=END).rows(spark, 3000)
    assert ledger.load(rows, partitions=4) == 3000
    assert ledger.rows.count() == 3000
    first = rows.first()
    assert ledger.insert_batch([tuple(first)]) == 1
    assert ledger.total_stats().first().total_transactions == 3001
    page = ledger.by_user(7, limit=5).collect()
    assert len(page) == 5 and {r.user_id for r in page} == {7}
    assert [r.created_at for r in page] == sorted((r.created_at for r in page), reverse=True)
    days = ledger.daily_revenue(10).collect()
    assert len(days) >= 10 and days[0].txn_date > days[-1].txn_date
    assert ledger.top_merchants(3).count() == 3
    assert ledger.revenue_by_merchant(limit=2).count() == 2
    assert ledger.category_breakdown().count() == 10
    assert ledger.status_distribution(30).count() == 6
    assert ledger.hourly_stats(2).count() <= 49
    assert ledger.spending_summary(7).first().merchants_used == 5
    report = ledger.report(30)
    assert len(report["merchants"].collect()) == 5
