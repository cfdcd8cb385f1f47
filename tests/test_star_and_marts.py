from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from ledgerloom.operators.standardize import to_silver
from ledgerloom.plans import calendar, marts, questions, star
from ledgerloom.plans.staging import stage
from tests.conftest import values


@pytest.fixture(scope="module")
def model(spark, raw_tables):
    staged = {t: stage(to_silver(df, t), t) for t, df in raw_tables.items()}
    days = calendar.calendar(spark, dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    return staged, days, star.fact_transaction(staged["transactions"], staged["accounts"], days)


def test_default_calendar(spark):
    days = calendar.calendar(spark)
    assert days.count() == 2191
    leap = days.filter("date_key = 20240229").first()
    assert (leap.year, leap.quarter, leap.month_name, leap.week_of_year, leap.day, leap.day_name, leap.is_weekend) == (
        2024, 1, "February", 9, 29, "Thursday", False
    )
    assert days.filter("is_weekend").filter("day_name not in ('Saturday', 'Sunday')").count() == 0
    with pytest.raises(ValueError):
        calendar.calendar(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1))


def test_fact_keeps_every_transaction(model, raw_tables):
    staged, days, facts = model
    assert facts.columns == star.TRANSACTION_COLUMNS
    assert facts.count() == raw_tables["transactions"].count()
    found = {(r.transaction_id, r.account_id): (r.customer_id, r.date_key) for r in facts.collect()}
    assert found["t1", "acc_00000001"] == ("cust_000001", 20240305)
    assert found["t4", "acc_99999999"] == (None, None)
    some = star.fact_transaction(staged["transactions"], staged["accounts"], days, ["transaction_id", "amount"])
    assert values(some) == values(facts, "transaction_id", "amount")


def test_event_fact(model):
    staged, days, _ = model
    events = star.fact_transaction_event(staged["transaction_events"], days)
    assert events.columns == star.EVENT_COLUMNS and events.count() == 5


def test_customer_mart_zero_fills(model):
    staged, _, facts = model
    mart = {r.customer_id: r for r in marts.customer_summary(staged["customers"], facts).collect()}
    ada, cy = mart["cust_000001"], mart["cust_000003"]
    assert (ada.total_transactions, ada.successful_transactions, ada.failed_transactions) == (2, 1, 1)
    assert ada.total_transaction_value == Decimal("3.81") and ada.average_transaction_amount == Decimal("1.270000")
    assert (cy.total_transactions, cy.total_transaction_value, cy.average_transaction_amount) == (0, 0, 0)
    assert cy.last_transaction_date is None
    assert len(mart) == 3


def test_merchant_mart_ignores_rows_without_merchant(model):
    staged, _, facts = model
    mart = {r.merchant_id: r for r in marts.merchant_performance(staged["merchants"], facts).collect()}
    assert mart["m1"].total_transactions == 2 and mart["m2"].total_transactions == 0


def test_daily_mart_covers_every_day(model):
    _, days, facts = model
    mart = {r.full_date: r for r in marts.daily_metrics(days, facts).collect()}
    assert len(mart) == 31
    assert mart[dt.date(2024, 3, 5)].total_transactions == 2
    assert mart[dt.date(2024, 3, 31)].total_transaction_value == 0


def test_failure_mart(model):
    staged, days, _ = model
    mart = marts.failure_analysis(star.fact_transaction_event(staged["transaction_events"], days))
    assert values(mart) == [("failed", None, 1, 1), ("failed", "fraud_detected", 1, 1), ("failed", "network_error", 1, 1)]


def test_totals_reconcile(spark, sf_dir):
    from ledgerloom.queries.standins import dim_date, facts, staged

    fact = facts(spark, sf_dir)
    total = questions.total_amount(fact).first()
    by_customer = marts.customer_summary(staged(spark, sf_dir, "customers"), fact).agg({"total_transaction_value": "sum", "total_transactions": "sum"}).first()
    by_day = marts.daily_metrics(dim_date(spark), fact).agg({"total_transaction_value": "sum", "total_transactions": "sum"}).first()
    for row in (by_customer, by_day):
        assert row["sum(total_transaction_value)"] == total.total_amount
        assert row["sum(total_transactions)"] == total.transactions


def test_questions(model):
    facts = model[2]
    assert values(questions.failed_count(facts)) == [(1,)]
    assert [r.customer_id for r in questions.top_by_value(facts, "customer_id", 1).collect()] == ["cust_000002"]
    assert [r.merchant_id for r in questions.top_by_volume(facts, "merchant_id", 5).collect()] == ["m1", "m9"]
    recent = questions.daily_volume(facts, dt.date(2024, 3, 6), 2)
    assert values(recent, "transaction_date") == [(dt.date(2024, 3, 5),), (dt.date(2024, 3, 6),)]
    rates = questions.failure_rate_by(facts, "account_id", dt.date(2024, 3, 7), 7)
    assert [(r.account_id, r.failure_rate) for r in rates.collect()] == [("acc_00000001", 0.3333), ("acc_00000002", 0.0)]
