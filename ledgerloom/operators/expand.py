"""Fixed tables of the domain as lookups, and the first transactions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerloom.functions.text import lookup

# Currencies, and merchant country -> currency.
CURRENCIES = ["INR", "USD", "EUR", "GBP", "AED", "SGD"]
COUNTRY_CURRENCY = {"IN": "INR", "US": "USD", "GB": "GBP", "DE": "EUR", "AE": "AED", "SG": "SGD"}
# Transaction type -> smallest and largest amount.
AMOUNT_RANGE = {
    "purchase": (50, 50_000),
    "withdrawal": (500, 50_000),
    "deposit": (1_000, 200_000),
    "transfer": (500, 100_000),
    "payment": (100, 50_000),
}


def first_transactions(transactions: DataFrame, n: int, order: Sequence[str] = ("transaction_id",)) -> DataFrame:
    """The first ``n`` transactions in a stated order, for a trial expansion."""
    return transactions.orderBy(*order).limit(n)


def with_country_currency(df: DataFrame, country: str = "country") -> DataFrame:
    """Add the currency of a country, null if the country is unknown."""
    return df.withColumn("country_currency", lookup(country, COUNTRY_CURRENCY))


def with_amount_range(df: DataFrame, kind: str = "transaction_type") -> DataFrame:
    """Add the smallest and largest usual amount of a transaction type, null if it is unknown."""
    return df.withColumns(
        {
            "smallest_amount": lookup(kind, {k: low for k, (low, _) in AMOUNT_RANGE.items()}),
            "largest_amount": lookup(kind, {k: high for k, (_, high) in AMOUNT_RANGE.items()}),
        }
    )
