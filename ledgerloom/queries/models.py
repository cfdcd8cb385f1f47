"""Facts, marts and the standing questions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.plans import marts, questions, star
from ledgerloom.queries import Registry, money
from ledgerloom.queries.loading import new_lake
from ledgerloom.queries.standins import dim_date, event_facts, facts, staged

REGISTRY = Registry({}, {})
query = REGISTRY.add

# The day the questions look back from.
TODAY = dt.date(2001, 10, 31)

REGISTRY.put("fact_transaction", facts, "SELECT * FROM facts")
REGISTRY.put("fact_transaction_event", event_facts, "SELECT * FROM event_facts")


@query(
    "fact_exchange_rate",
    "SELECT exchange_rate_id, base_currency, target_currency, rate, rate_date, source FROM silver_exchange_rates",
)
def fact_exchange_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_exchange_rate(staged(spark, sf_dir, "exchange_rates"))


def mean_sql(amount: str) -> str:
    """Mean of a decimal(18,2) column, rounded half up to six places in whole numbers."""
    cents = f"CAST(sum({amount}) * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} * 10000 + count({amount})) // (2 * count({amount})) AS DOUBLE) / 1000000"


MEASURES = f"""
    count(f.transaction_id) AS total_transactions,
    count(*) FILTER (f.transaction_status = 'completed') AS successful_transactions,
    count(*) FILTER (f.transaction_status = 'failed') AS failed_transactions,
    coalesce(CAST(sum(f.amount) AS DOUBLE), 0) AS total_transaction_value,
    CASE WHEN count(f.amount) = 0 THEN 0 ELSE {mean_sql("f.amount")} END AS average_transaction_amount
"""


def published(mart: DataFrame) -> DataFrame:
    """Decimal measures as double."""
    return money(mart, "total_transaction_value", "average_transaction_amount")


@query(
    "customer_summary",
    f"""
    SELECT c.customer_id, c.first_name, c.last_name, c.country, c.customer_status, {MEASURES},
           max(f.transaction_date) AS last_transaction_date
    FROM silver_customers c LEFT JOIN facts f ON f.customer_id = c.customer_id
    GROUP BY c.customer_id, c.first_name, c.last_name, c.country, c.customer_status
    """,
)
def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(marts.customer_summary(staged(spark, sf_dir, "customers"), facts(spark, sf_dir)))


@query(
    "merchant_performance",
    f"""
    SELECT m.merchant_id, m.merchant_name, m.merchant_category, m.country, m.city, m.merchant_status, {MEASURES}
    FROM silver_merchants m LEFT JOIN facts f ON f.merchant_id = m.merchant_id
    GROUP BY m.merchant_id, m.merchant_name, m.merchant_category, m.country, m.city, m.merchant_status
    """,
)
def merchant_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(marts.merchant_performance(staged(spark, sf_dir, "merchants"), facts(spark, sf_dir)))


@query(
    "daily_metrics",
    f"""
    SELECT d.full_date, d.year, d.month, d.month_name, {MEASURES}
    FROM days d LEFT JOIN facts f ON f.date_key = d.date_key
    GROUP BY d.full_date, d.year, d.month, d.month_name
    """,
)
def daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(marts.daily_metrics(dim_date(spark), facts(spark, sf_dir)))


@query(
    "failure_analysis",
    """
    SELECT event_type, failure_reason, count(event_id) AS total_events,
           count(DISTINCT transaction_id) AS affected_transactions
    FROM event_facts WHERE event_type = 'failed' GROUP BY event_type, failure_reason
    """,
)
def failure_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.failure_analysis(event_facts(spark, sf_dir))


@query(
    "failure_sketches",
    """
    SELECT event_type, failure_reason, count(event_id) AS total_events, TRUE AS close
    FROM event_facts WHERE event_type = 'failed' AND event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY event_type, failure_reason
    """,
)
def failure_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen days from stored sketches; close means within 2 % of the exact number of transactions."""
    lake = new_lake(spark, "sketches")
    events, days = event_facts(spark, sf_dir), (dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    lake.replace("marts", "failure_sketches", marts.failure_sketches(events))
    found = marts.failures_between(lake.read("marts", "failure_sketches"), *days)
    exact = marts.failure_analysis(events.filter(F.col("event_date").between(*days))).select(F.col("failure_reason").alias("reason"), F.col("affected_transactions").alias("exact"))
    close = F.abs(F.col("affected_transactions") - F.col("exact")) <= F.ceil(0.02 * F.col("exact"))
    return found.join(exact, F.col("failure_reason").eqNullSafe(F.col("reason"))).select("event_type", "failure_reason", "total_events", close.alias("close"))


@query(
    "q_total", "SELECT CAST(sum(amount) AS DOUBLE) AS total_amount, count(*) AS transactions FROM silver_transactions"
)
def q_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(questions.total_amount(facts(spark, sf_dir, "amount")), "total_amount")


@query(
    "q_total_by_type",
    "SELECT transaction_type, CAST(sum(amount) AS DOUBLE) AS total_amount FROM silver_transactions GROUP BY ALL",
)
def q_total_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(questions.amount_by(facts(spark, sf_dir, "amount", "transaction_type"), "transaction_type"), "total_amount")


@query(
    "q_common_types",
    "SELECT transaction_type, count(*) AS transactions FROM silver_transactions GROUP BY ALL ORDER BY 2 DESC, 1",
)
def q_common_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.most_common(facts(spark, sf_dir, "transaction_type"), "transaction_type")


@query(
    "q_top_merchants",
    """
    SELECT merchant_id, count(*) AS transactions FROM facts WHERE merchant_id IS NOT NULL
    GROUP BY merchant_id ORDER BY transactions DESC, merchant_id LIMIT 10
    """,
)
def q_top_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.top_by_volume(facts(spark, sf_dir, "merchant_id"), "merchant_id")


@query(
    "q_top_customers",
    """
    SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS total_amount FROM facts WHERE customer_id IS NOT NULL
    GROUP BY customer_id ORDER BY sum(amount) DESC, customer_id LIMIT 10
    """,
)
def q_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(questions.top_by_value(facts(spark, sf_dir, "customer_id", "amount"), "customer_id"), "total_amount")


@query(
    "q_failed",
    "SELECT count(*) FILTER (transaction_status = 'failed') AS failed_transactions FROM silver_transactions",
)
def q_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.failed_count(facts(spark, sf_dir, "transaction_status"))


@query(
    "q_avg_by_currency",
    f"SELECT currency, {mean_sql('amount')} AS average_amount FROM silver_transactions GROUP BY currency",
)
def q_avg_by_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(questions.average_by(facts(spark, sf_dir, "amount", "currency"), "currency"), "average_amount")


DAILY = "SELECT transaction_date, count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS total_amount FROM stg_transactions"


@query("q_daily", f"{DAILY} GROUP BY transaction_date")
def q_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(questions.daily_volume(facts(spark, sf_dir, "transaction_date", "amount")), "total_amount")


@query(
    "q_last_30_days",
    f"{DAILY} WHERE transaction_date BETWEEN DATE '2001-10-02' AND DATE '2001-10-31' GROUP BY transaction_date",
)
def q_last_30_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(questions.daily_volume(facts(spark, sf_dir, "transaction_date", "amount"), TODAY, 30), "total_amount")


@query(
    "q_merchant_failure_rate",
    """
    SELECT merchant_id, count(*) AS transactions,
           round(CAST(count(*) FILTER (transaction_status = 'failed') AS DOUBLE) / count(*), 4) AS failure_rate
    FROM facts
    WHERE transaction_date BETWEEN DATE '2001-10-25' AND DATE '2001-10-31' AND merchant_id IS NOT NULL
    GROUP BY merchant_id ORDER BY failure_rate DESC, transactions DESC, merchant_id LIMIT 10
    """,
)
def q_merchant_failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions.failure_rate_by(facts(spark, sf_dir, "merchant_id", "transaction_date", "transaction_status"), "merchant_id", TODAY)
