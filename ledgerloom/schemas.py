"""Declared schemas, keys and column contracts of the six datasets."""

from __future__ import annotations

LAYERS = ("bronze", "silver", "gold", "marts", "ai")

# Dataset names, column names and types as the source systems deliver them.
RAW = {
    "customers": (
        "customer_id string, first_name string, last_name string, email string, phone string, "
        "date_of_birth date, country string, created_at timestamp, updated_at timestamp_ntz, "
        "customer_status string"
    ),
    "accounts": (
        "account_id string, customer_id string, account_type string, currency string, "
        "balance double, account_status string, opened_at timestamp, updated_at timestamp"
    ),
    "merchants": (
        "merchant_id string, merchant_name string, merchant_category string, country string, "
        "city string, currency string, merchant_status string, created_at timestamp, "
        "updated_at timestamp_ntz"
    ),
    "exchange_rates": (
        "exchange_rate_id string, base_currency string, target_currency string, rate double, "
        "rate_date date, source string"
    ),
    "transactions": (
        "transaction_id string, account_id string, merchant_id string, "
        "transaction_timestamp timestamp, transaction_type string, amount double, currency string, "
        "transaction_status string, payment_method string, description string"
    ),
    "transaction_events": (
        "event_id string, transaction_id string, event_type string, event_timestamp timestamp, "
        "event_status string, failure_reason string"
    ),
}

# A streamed transaction carries its time as ISO-8601 text.
STREAM_TRANSACTION = RAW["transactions"].replace(
    "transaction_timestamp timestamp", "transaction_timestamp string"
)

PRIMARY_KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "merchants": "merchant_id",
    "exchange_rates": "exchange_rate_id",
    "transactions": "transaction_id",
    "transaction_events": "event_id",
}

INGESTED_AT = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"
STAMP_COLUMNS = (INGESTED_AT, SOURCE_FILE)

# Transaction types that must name a merchant.
MERCHANT_TYPES = ("payment", "purchase")


def ddl_columns(ddl: str) -> list[str]:
    """Column names of a flat DDL schema string, in order."""
    return [part.split()[0] for part in ddl.split(", ")]


def layer_name(custom: str | None, default: str) -> str:
    """Database for a model: its own layer name verbatim when set, else the default."""
    return default if custom is None else custom.strip()
