"""Facts of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import key_join

# Column order of the facts.
TRANSACTION_COLUMNS = [
    "transaction_id", "account_id", "customer_id", "merchant_id", "date_key", "transaction_timestamp",
    "transaction_date", "transaction_type", "amount", "currency", "transaction_status",
    "payment_method", "description",
]
EVENT_COLUMNS = [
    "event_id", "transaction_id", "event_date", "event_timestamp", "event_type", "event_status",
    "failure_reason", "date_key",
]


def with_date_key(df: DataFrame, date_column: str, dim_date: DataFrame) -> DataFrame:
    """Left-join the calendar; a day outside it gets a null key.

    ``dim_date`` comes from :func:`ledgerloom.plans.calendar.calendar`, which bounds its rows, so it
    is always broadcast and no fact row moves.
    """
    days = dim_date.select(F.col("full_date").alias(date_column), "date_key")
    return df.join(F.broadcast(days), date_column, "left")


def fact_transaction(
    transactions: DataFrame, accounts: DataFrame, dim_date: DataFrame, columns: Sequence[str] = tuple(TRANSACTION_COLUMNS)
) -> DataFrame:
    """One row per staged transaction, with the account's customer and the date key if they exist.

    Where ``columns`` leaves one of the two out, its join is left out too.
    """
    facts = transactions
    if "customer_id" in columns:
        facts = key_join(facts, accounts.select("account_id", "customer_id"), "account_id", "left")
    if "date_key" in columns:
        facts = with_date_key(facts, "transaction_date", dim_date)
    return facts.select(*columns)


def fact_transaction_event(events: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row per staged lifecycle event, with its date key if it exists."""
    return with_date_key(events, "event_date", dim_date).select(*EVENT_COLUMNS)


def fact_exchange_rate(rates: DataFrame) -> DataFrame:
    """Staged rates, unchanged."""
    return rates.select("exchange_rate_id", "base_currency", "target_currency", "rate", "rate_date", "source")
