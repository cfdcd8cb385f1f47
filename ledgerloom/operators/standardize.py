"""Raw-to-Silver standardisation, driven by one rule table per dataset.

Every rule is a column expression, so a dataset is standardised in one narrow projection: no
shuffle, and whatever filter or column choice follows is pushed through to the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import lowered, trimmed, uppered
from ledgerloom.schemas import MERCHANT_TYPES, STAMP_COLUMNS

# A value that does not parse becomes null, so one bad row does not fail the load; `parse_losses` finds them.
KINDS = {
    "trim": trimmed,
    "lower": lowered,
    "upper": uppered,
    "date": lambda c: F.col(c).try_cast("date"),
    "timestamp": lambda c: F.col(c).try_cast("timestamp"),
    "money": lambda c: F.col(c).try_cast("decimal(18,2)"),
}

# Rules that may find no value in their input.
PARSED = ("date", "timestamp", "money")

# Dataset -> output column -> (rule, input column).
SILVER_RULES: dict[str, dict[str, tuple[str, str]]] = {
    "customers": {
        "first_name": ("trim", "first_name"),
        "last_name": ("trim", "last_name"),
        "email": ("lower", "email"),
        "country": ("upper", "country"),
        "customer_status": ("lower", "customer_status"),
        "date_of_birth": ("date", "date_of_birth"),
    },
    "accounts": {
        "account_type": ("lower", "account_type"),
        "account_status": ("lower", "account_status"),
        "currency": ("upper", "currency"),
    },
    "merchants": {
        "merchant_name": ("trim", "merchant_name"),
        "merchant_category": ("lower", "merchant_category"),
        "country": ("upper", "country"),
        "status": ("lower", "merchant_status"),
    },
    "exchange_rates": {
        "from_currency": ("upper", "base_currency"),
        "to_currency": ("upper", "target_currency"),
        "rate_date": ("date", "rate_date"),
    },
    "transactions": {
        "transaction_type": ("lower", "transaction_type"),
        "transaction_status": ("lower", "transaction_status"),
        "payment_method": ("lower", "payment_method"),
        "currency": ("upper", "currency"),
        "transaction_timestamp": ("timestamp", "transaction_timestamp"),
        "amount": ("money", "amount"),
    },
    "transaction_events": {
        "event_type": ("lower", "event_type"),
        "event_status": ("lower", "event_status"),
        "failure_reason": ("lower", "failure_reason"),
        "event_timestamp": ("timestamp", "event_timestamp"),
    },
}


def apply_rules(df: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Replace or add each rule's output column; other columns pass through."""
    return df.withColumns({out: KINDS[kind](source) for out, (kind, source) in rules.items()})


def to_silver(df: DataFrame, dataset: str) -> DataFrame:
    """Silver form of a Bronze dataset: standardised columns, ingestion stamps dropped."""
    return apply_rules(df, SILVER_RULES[dataset]).drop(*STAMP_COLUMNS)


def parse_losses(dataset: str) -> dict[str, Column]:
    """For each typed rule: true where the input has a value and the output none."""
    lost = {}
    for out, (kind, source) in SILVER_RULES[dataset].items():
        if kind in PARSED:
            given = F.col(source).isNotNull() & (F.trim(F.col(source).cast("string")) != "")
            lost[out] = given & KINDS[kind](source).isNull()
    return lost


def merchant_id_valid(kind: str = "transaction_type", merchant: str = "merchant_id") -> Column:
    """False for a purchase or payment without merchant, else true (also for a null type)."""
    breach = F.col(kind).isin(*MERCHANT_TYPES) & F.col(merchant).isNull()
    return ~F.coalesce(breach, F.lit(False))


def as_fields(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each row as (keys, Field, Value) with one output row per remaining column."""
    rest = [c for c in df.columns if c not in keys]
    text = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in rest])
    return text.unpivot(keys, rest, "Field", "Value")
