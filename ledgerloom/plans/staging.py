"""Staging projections: the pinned columns that the star schema may read from Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dataset -> columns in order. A pair derives the first column from the second.
COLUMNS: dict[str, list[str | tuple[str, str]]] = {
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone", "date_of_birth", "country",
        "created_at", ("updated_at", "timestamp"), "customer_status",
    ],
    "accounts": [
        "account_id", "customer_id", "account_type", "currency", "balance", "account_status",
        "opened_at", ("updated_at", "timestamp"),
    ],
    "merchants": [
        "merchant_id", "merchant_name", "merchant_category", "country", "city", "currency",
        "merchant_status", "created_at", ("updated_at", "timestamp"), "status",
    ],
    "exchange_rates": [
        "exchange_rate_id", "base_currency", "target_currency", "rate", "rate_date", "source",
    ],
    "transactions": [
        "transaction_id", "account_id", "merchant_id", "transaction_timestamp",
        ("transaction_date", "transaction_timestamp"), "transaction_type", "amount", "currency",
        "transaction_status", "payment_method", "description",
    ],
    "transaction_events": [
        "event_id", "transaction_id", "event_type", "event_timestamp",
        ("event_date", "event_timestamp"), "event_status", "failure_reason",
    ],
}


def stage(silver: DataFrame, dataset: str) -> DataFrame:
    """Staging view of a Silver dataset."""
    return silver.select(*[_column(c) for c in COLUMNS[dataset]])


def _column(spec: str | tuple[str, str]) -> Column:
    if isinstance(spec, str):
        return F.col(spec)
    name, source = spec
    if source == "timestamp":
        return F.col(name).cast("timestamp").alias(name)
    return F.to_date(source).alias(name)
