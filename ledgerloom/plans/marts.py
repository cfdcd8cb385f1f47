"""Business marts.

Each mart rolls the fact up by the dimension key before it meets the dimension: the map side
combines the rows of a key, so the shuffle carries one row per key and task however hot a key is,
and the join that follows has at most one row per key on both sides.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct-count sketch, as a power of two.
HLL_BITS = 14
ZERO_COUNTS = ("total_transactions", "successful_transactions", "failed_transactions")


def _measures() -> list[Column]:
    identified = F.col("transaction_id").isNotNull()
    return [
        F.count("transaction_id").alias("total_transactions"),
        F.count_if(identified & (F.col("transaction_status") == "completed")).alias("successful_transactions"),
        F.count_if(identified & (F.col("transaction_status") == "failed")).alias("failed_transactions"),
        F.sum("amount").alias("total_transaction_value"),
        F.avg("amount").alias("average_transaction_amount"),
    ]


def zero_filled(dimension: DataFrame, facts: DataFrame, key: str, extra: list[Column] | None = None) -> DataFrame:
    """Transaction measures for every dimension row, 0 where the key has no fact row.

    Facts with a null key belong to no dimension row and are left out. ``extra`` adds aggregates
    that stay null for an empty key.
    """
    rolled = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(*_measures(), *(extra or []))
    filled = {
        c: F.coalesce(F.col(c), F.lit(0).cast(rolled.schema[c].dataType))
        for c in (*ZERO_COUNTS, "total_transaction_value", "average_transaction_amount")
    }
    return dimension.join(rolled, key, "left").withColumns(filled)


def customer_summary(customers: DataFrame, facts: DataFrame) -> DataFrame:
    """Volume, value, outcome counts and last day per customer."""
    profile = customers.select("customer_id", "first_name", "last_name", "country", "customer_status")
    last_day = F.max("transaction_date").alias("last_transaction_date")
    return zero_filled(profile, facts, "customer_id", [last_day])


def merchant_performance(merchants: DataFrame, facts: DataFrame) -> DataFrame:
    """Volume, value and outcome counts per merchant."""
    profile = merchants.select(
        "merchant_id", "merchant_name", "merchant_category", "country", "city", "merchant_status"
    )
    return zero_filled(profile, facts, "merchant_id")


def daily_metrics(dim_date: DataFrame, facts: DataFrame) -> DataFrame:
    """Volume, value and outcome counts of every calendar day."""
    days = dim_date.select("date_key", "full_date", "year", "month", "month_name")
    return zero_filled(days, facts, "date_key").drop("date_key")


def failure_analysis(events: DataFrame) -> DataFrame:
    """Failed events and the transactions they hit, per reason."""
    return (
        events.filter(F.col("event_type") == "failed")
        .groupBy("event_type", "failure_reason")
        .agg(
            F.count("event_id").alias("total_events"),
            F.count_distinct("transaction_id").alias("affected_transactions"),
        )
    )


def failure_sketches(events: DataFrame, day: str = "event_date") -> DataFrame:
    """Failed events per day and reason, with a sketch of the transactions they hit; one small row for each.

    Counts and sketches of days add up, so a longer range reads these rows and no event; see :func:`failures_between`.
    """
    failed = events.filter(F.col("event_type") == "failed").groupBy(day, "event_type", "failure_reason")
    return failed.agg(F.count("event_id").alias("total_events"), F.hll_sketch_agg("transaction_id", F.lit(HLL_BITS)).alias("transactions"))


def failures_between(sketches: DataFrame, first: dt.date, last: dt.date, day: str = "event_date") -> DataFrame:
    """:func:`failure_analysis` of some days, both ends included, from their sketches.

    Events are exact; ``affected_transactions`` is an estimate, one standard error being 0.65 % (HLL_BITS of 14).
    """
    return (
        sketches.filter(F.col(day).between(F.lit(first), F.lit(last)))
        .groupBy("event_type", "failure_reason")
        .agg(F.sum("total_events").alias("total_events"), F.hll_sketch_estimate(F.hll_union_agg("transactions")).alias("affected_transactions"))
    )
