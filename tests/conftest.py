from __future__ import annotations

import datetime as dt

import pytest

from ledgerloom.schemas import RAW
from ledgerloom.session import local_session
from ledgerloom.sources.lake import Lake

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "ledgerloom-tests")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), f"_{tmp_path.name.replace('-', '_').lower()}")


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def utc(text: str) -> dt.datetime:
    return at(text).replace(tzinfo=dt.timezone.utc)


DAY = dt.date(2024, 3, 5)


def raw_rows() -> dict[str, list[tuple]]:
    """A small lake in the declared schemas, with blanks, mixed case, nulls, orphans and duplicates."""
    t = utc("2024-03-05 10:00:00")
    return {
        "customers": [
            ("cust_000001", " Ada ", "Lovelace ", " Ada@Example.COM", "1", dt.date(1990, 1, 1), " in", t, at("2024-03-01"), " Active "),
            ("cust_000002", "Bo", None, None, None, None, "IN ", t, at("2024-03-02"), "INACTIVE"),
            ("cust_000003", "Cy", "No Trades", "cy@example.com", "3", dt.date(2000, 2, 29), "in", t, None, "active"),
        ],
        "accounts": [
            ("acc_00000001", "cust_000001", " Checking", "inr ", 10.0, "ACTIVE ", t, t),
            ("acc_00000002", "cust_000002", "savings", "USD", 20.5, "frozen", t, t),
            ("acc_00000003", "cust_999999", "Investment", " eur", 30.0, "Inactive", t, t),
            ("acc_00000004", None, "savings", "GBP", 0.0, "active", t, t),
        ],
        "merchants": [
            ("m1", " Corner Shop ", "Grocery ", "in ", "Pune", "INR", " ACTIVE", t, at("2024-03-01")),
            ("m2", "Idle", "fuel", "US", None, "USD", "Inactive", t, at("2024-03-01")),
        ],
        "exchange_rates": [
            ("fx_00000001", " inr", "usd ", 0.012, DAY, "p"),
            ("fx_00000002", "USD", "INR", 83.0, DAY, "p"),
        ],
        "transactions": [
            ("t1", "acc_00000001", "m1", utc("2024-03-05 00:00:00"), " Purchase", 0.125, "inr", "COMPLETED ", "Card", "a"),
            ("t2", "acc_00000001", None, utc("2024-03-05 23:59:59"), "payment", 2.675, "INR", "failed", "upi", None),
            ("t3", "acc_00000002", None, utc("2024-03-06 12:00:00"), "Deposit ", 100.0, " usd ", "Pending", "cash", "c"),
            ("t4", "acc_99999999", "m9", utc("2030-01-01 00:00:00"), "purchase", 5.0, "EUR", "reversed", "online", "d"),
            ("t4", None, "m1", utc("2024-03-07 08:00:00"), "payment", 7.0, "EUR", "completed", "online", "e"),
            (None, "acc_00000001", "m1", utc("2024-03-07 08:00:00"), None, None, None, None, None, None),
            (None, "acc_00000001", None, None, "transfer", 1.0, "GBP", "completed", "card", None),
        ],
        "transaction_events": [
            ("e1", "t1", " Initiated", utc("2024-03-05 00:00:10"), "SUCCESS", None),
            ("e2", "t2", "failed", utc("2024-03-05 23:59:59"), "Failure ", " Network_Error "),
            ("e3", "t2", "FAILED", utc("2024-03-06 00:00:01"), "failure", None),
            ("e4", "t_missing", "failed", utc("2024-03-06 00:00:01"), "failure", "fraud_detected"),
            ("e4", None, "completed", utc("2024-03-06 00:00:01"), "success", None),
        ],
    }


@pytest.fixture(scope="session")
def raw_tables(spark):
    return {name: spark.createDataFrame(rows, RAW[name]) for name, rows in raw_rows().items()}


def values(df, *columns):
    """Rows as a sorted list of tuples; nulls sort first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])
