"""The standing questions asked of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_amount(facts: DataFrame) -> DataFrame:
    return facts.agg(F.sum("amount").alias("total_amount"), F.count(F.lit(1)).alias("transactions"))


def amount_by(facts: DataFrame, column: str) -> DataFrame:
    return facts.groupBy(column).agg(F.sum("amount").alias("total_amount"))


def average_by(facts: DataFrame, column: str) -> DataFrame:
    return facts.groupBy(column).agg(F.avg("amount").alias("average_amount"))


def most_common(facts: DataFrame, column: str) -> DataFrame:
    """Values by how often they occur, most frequent first."""
    counted = facts.groupBy(column).agg(F.count(F.lit(1)).alias("transactions"))
    return counted.orderBy(F.col("transactions").desc(), column)


def top_by_volume(facts: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` keys with most transactions; ties go to the smaller key."""
    counted = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("transactions"))
    return counted.orderBy(F.col("transactions").desc(), key).limit(n)


def top_by_value(facts: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` keys with the highest total amount; ties go to the smaller key."""
    summed = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("amount").alias("total_amount"))
    return summed.orderBy(F.col("total_amount").desc(), key).limit(n)


def failed_count(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count_if(F.col("transaction_status") == "failed").alias("failed_transactions"))


def daily_volume(facts: DataFrame, last: dt.date | None = None, days: int | None = None) -> DataFrame:
    """Transactions and amount per day, over all days or the ``days`` days up to ``last``."""
    if days is not None:
        facts = _recent(facts, last, days)
    return facts.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("total_amount")
    )


def failure_rate_by(facts: DataFrame, key: str, last: dt.date, days: int = 7, n: int = 10) -> DataFrame:
    """The ``n`` keys with the highest share of failed transactions in the period."""
    rate = F.round(F.count_if(F.col("transaction_status") == "failed") / F.count(F.lit(1)), 4)
    counted = (
        _recent(facts, last, days)
        .filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("transactions"), rate.alias("failure_rate"))
    )
    return counted.orderBy(F.col("failure_rate").desc(), F.col("transactions").desc(), key).limit(n)


def latest_from_source(df: DataFrame, fragment: str, source: str, order: list[str], n: int = 20) -> DataFrame:
    """Newest ``n`` rows whose source path contains ``fragment``; ``order`` is newest-first."""
    newest = [F.col(order[0]).desc(), *order[1:]]
    return df.filter(F.col(source).contains(fragment)).orderBy(*newest).limit(n)


def _recent(facts: DataFrame, last: dt.date, days: int) -> DataFrame:
    first = last - dt.timedelta(days=days - 1)
    return facts.filter(F.col("transaction_date").between(F.lit(first), F.lit(last)))
