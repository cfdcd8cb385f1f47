from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators.standardize import as_fields, merchant_id_valid, to_silver
from ledgerloom.plans.staging import COLUMNS, stage
from ledgerloom.schemas import RAW
from ledgerloom.sources.files import stamp
from tests.conftest import values


def test_text_rules(raw_tables):
    silver = to_silver(raw_tables["customers"], "customers")
    assert values(silver, "first_name", "email", "country", "customer_status")[0] == ("Ada", "ada@example.com", "IN", "active")
    assert values(silver, "last_name")[0] == (None,)


def test_merchants_keep_raw_status_beside_the_clean_copy(raw_tables):
    silver = to_silver(raw_tables["merchants"], "merchants")
    assert values(silver, "merchant_id", "merchant_status", "status") == [("m1", " ACTIVE", "active"), ("m2", "Inactive", "inactive")]


def test_rates_keep_the_raw_pair(raw_tables):
    silver = to_silver(raw_tables["exchange_rates"], "exchange_rates")
    first = silver.filter("exchange_rate_id = 'fx_00000001'").first()
    assert (first.base_currency, first.from_currency, first.to_currency) == (" inr", "INR", "USD")
    assert "from_currency" not in stage(silver, "exchange_rates").columns


def test_amount_rounds_half_up_and_bad_values_become_null(spark, raw_tables):
    silver = to_silver(raw_tables["transactions"], "transactions")
    amounts = {r.transaction_id: r.amount for r in silver.collect()}
    assert amounts["t1"] == Decimal("0.13") and amounts["t2"] == Decimal("2.68")
    text = spark.createDataFrame(
        [("x", "card", "not a number", "2024-01-01T10:00:00Z"), ("y", "card", "1e30", "yesterday")],
        "transaction_type string, payment_method string, amount string, transaction_timestamp string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("transaction_status", "currency")})
    parsed = to_silver(text, "transactions").collect()
    assert [r.amount for r in parsed] == [None, None]
    assert parsed[0].transaction_timestamp is not None and parsed[1].transaction_timestamp is None


def test_stamps_are_dropped_and_no_rows_are(spark, raw_tables, tmp_path):
    path = str(tmp_path / "t")
    raw_tables["transactions"].write.parquet(path)
    bronze = stamp(spark.read.schema(RAW["transactions"]).parquet(path))
    assert {"_ingestion_timestamp", "_source_file"} <= set(bronze.columns)
    silver = to_silver(bronze, "transactions")
    assert silver.columns == raw_tables["transactions"].columns
    assert silver.count() == 7


def test_merchant_flag_is_true_for_a_null_type(raw_tables):
    flagged = to_silver(raw_tables["transactions"], "transactions").select("transaction_type", merchant_id_valid().alias("ok"))
    assert flagged.filter("not ok").count() == 1
    assert flagged.filter("transaction_type is null and ok").count() == 1


def test_staging_pins_columns_and_dates(raw_tables):
    for dataset, df in raw_tables.items():
        staged = stage(to_silver(df, dataset), dataset)
        assert staged.columns == [c if isinstance(c, str) else c[0] for c in COLUMNS[dataset]]
    transactions = stage(to_silver(raw_tables["transactions"], "transactions"), "transactions")
    assert transactions.filter("transaction_id = 't2'").first().transaction_date == dt.date(2024, 3, 5)
    customers = stage(to_silver(raw_tables["customers"], "customers"), "customers")
    assert dict(customers.dtypes)["updated_at"] == "timestamp"


def test_fields_form(raw_tables):
    pairs = as_fields(raw_tables["merchants"].select("merchant_id", "city", "currency"), ["merchant_id"])
    assert values(pairs) == [("m1", "city", "Pune"), ("m1", "currency", "INR"), ("m2", "city", None), ("m2", "currency", "USD")]
