from __future__ import annotations

from ledgerloom.functions.text import lookup
from ledgerloom.operators.expand import COUNTRY_CURRENCY, first_transactions, with_amount_range


def test_first_transactions(spark):
    df = spark.createDataFrame([(f"t{i}",) for i in (7, 3, 10, 0, 1)], "transaction_id string").repartition(3)
    assert [r.transaction_id for r in first_transactions(df, 3).collect()] == ["t0", "t1", "t10"]


def test_lookup_of_an_unknown_key_is_null(spark):
    df = spark.createDataFrame([("IN",), ("XX",), (None,)], "c string")
    assert [r[0] for r in df.select(lookup("c", COUNTRY_CURRENCY)).collect()] == ["INR", None, None]


def test_amount_range(spark):
    df = spark.createDataFrame([("deposit",), ("gift",)], "transaction_type string")
    assert [tuple(r) for r in with_amount_range(df).collect()] == [("deposit", 1000, 200_000), ("gift", None, None)]
