from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import profile, quality
from ledgerloom.operators.standardize import to_silver
from ledgerloom.schemas import PRIMARY_KEYS, RAW
from tests.conftest import values


def test_key_report_counts_all_nulls_as_one_key(raw_tables):
    row = profile.key_report(raw_tables["transactions"], "transaction_id", "transactions").first()
    assert (row.total_rows, row.distinct_keys, row.duplicate_rows, row.null_keys, row.repeated_keys) == (7, 5, 2, 2, 1)
    empty = profile.key_report(raw_tables["transactions"].limit(0), "transaction_id", "t").first()
    assert (empty.total_rows, empty.distinct_keys, empty.duplicate_rows) == (0, 0, 0)


def test_null_counts(raw_tables):
    counted = dict(values(profile.null_counts(raw_tables["customers"])))
    assert counted["email"] == 1 and counted["customer_id"] == 0 and len(counted) == 10
    by_type = dict(values(profile.null_counts_by(raw_tables["transactions"], "transaction_type", "merchant_id")))
    assert by_type == {" Purchase": 0, "payment": 1, "Deposit ": 1, "purchase": 0, None: 0, "transfer": 1}


def test_orphans_with_and_without_null_keys(raw_tables):
    child, parent = raw_tables["accounts"], raw_tables["customers"]
    assert values(quality.orphan_count(child, parent, "customer_id")) == [(2, 2)]
    assert values(quality.orphan_count(child, parent, "customer_id", null_is_orphan=False)) == [(1, 1)]
    rows = quality.orphan_rows(child, parent, "customer_id")
    assert values(rows, "account_id") == [("acc_00000003",), ("acc_00000004",)]
    rows = quality.orphan_rows(child, parent, "customer_id", null_is_orphan=False)
    assert values(rows, "account_id") == [("acc_00000003",)]


def test_bronze_report_finds_every_planted_fault(raw_tables):
    silver = {t: to_silver(df, t) for t, df in raw_tables.items()}
    report = {(r.check_name, r.table_name, r.column_name): r.failing_rows for r in quality.bronze_report(silver, PRIMARY_KEYS).collect()}
    found = {k: n for k, n in report.items() if n}
    assert found == {
        ("not_null", "transactions", "transaction_id"): 2,
        ("unique", "transactions", "transaction_id"): 1,
        ("unique", "transaction_events", "event_id"): 1,
        ("relationship", "accounts", "customer_id"): 2,
        ("relationship", "transactions", "account_id"): 2,
        ("relationship", "transactions", "merchant_id"): 2,
        ("relationship", "transaction_events", "transaction_id"): 2,
        ("merchant_required", "transactions", "merchant_id"): 1,
        ("reason_required", "transaction_events", "failure_reason"): 1,
    }
    assert len(report) == 18


def test_failed_without_reason(raw_tables):
    silver = to_silver(raw_tables["transaction_events"], "transaction_events")
    assert values(quality.failed_without_reason(silver), "event_id") == [("e3",)]


def test_contract_list():
    kinds = [type(c).__name__ for c in quality.GOLD_CONTRACTS]
    assert (kinds.count("NotNull"), kinds.count("Unique"), kinds.count("Relationship")) == (11, 6, 4)


def test_schema_check(spark, tmp_path):
    """Of files, whose columns are not the declared ones."""
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "x", 1e9), ("y", None, 2.5), (None, "z", None)], "a string, b string, c double").write.parquet(path)
    found = quality.schema_check({"t": spark.read.parquet(path)}, {"t": "a int, b string, c decimal(6,2), d date"})
    assert values(found) == [("t", "a", "int", 1), ("t", "b", "string", 0), ("t", "c", "decimal(6,2)", 1), ("t", "d", "date", None)]


def test_parse_losses_and_null_counts(spark, raw_tables):
    dates = F.when(F.col("customer_id") == "cust_000001", "soon").when(F.col("customer_id") == "cust_000002", " ").otherwise("2000-02-29")
    tables = {
        "customers": raw_tables["customers"].withColumn("date_of_birth", dates),
        "transactions": raw_tables["transactions"].withColumn("amount", F.when(F.col("amount") > 6, 1e17).otherwise(F.col("amount"))),
    }
    found = {r.column_name: (r.failing_rows, r.passed) for r in quality.parse_report(tables).collect()}
    assert found == {"date_of_birth": (1, False), "transaction_timestamp": (0, True), "amount": (2, False)}
    nulls = {r.column_name: (r.failing_rows, r.passed) for r in quality.null_report({"customers": tables["customers"]}).collect()}
    assert nulls["email"] == (1, True) and nulls["customer_id"] == (0, True)


def test_one_count_for_each_key(spark, tmp_path):
    tables = {}
    for name, ddl in (("p", "id int"), ("c", "id int, p int, q int")):
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    contracts = [quality.NotNull("p", "id"), quality.Unique("p", "id"), quality.NotNull("c", "id"), quality.Unique("c", "id"),
                 quality.NotNull("c", "p"), quality.Relationship("c", "p", "p", "id"), quality.NotNull("c", "q")]
    results = quality.run_contracts(tables, contracts)
    results.collect()
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert len(values(results)) == 7 and plan.split("Initial Plan")[0].count("FileScan parquet") <= 5


def test_numeric_profile_skips_infinities(spark):
    df = spark.createDataFrame([(1.0, 1, "x"), (float("inf"), 2, "y"), (float("nan"), 3, "z"), (None, None, None)], "a double, b int, c string")
    assert values(profile.numeric_profile(df)) == [("a", 1, 1.0, 1.0, 1.0), ("b", 3, 1.0, 3.0, 2.0)]
    assert values(profile.shape(df)) == [(4, 3, 2)]


def test_detection_metrics(spark):
    df = spark.createDataFrame([(True,), (False,), (False,)], "is_anomaly boolean")
    assert values(profile.detection_metrics(df)) == [(3, 1, 33.33)]
    assert values(profile.detection_metrics(df.limit(0))) == [(0, 0, None)]


def test_contracts_scan_each_table_once(spark, tmp_path):
    """Against a plain reading of each contract: hot, null and repeated keys, keys of two types, children without rows."""
    rows = {
        "p": ("id int, name string", [(1, "a"), (2, "b"), (2, None), (None, "c"), (9, "c")]),
        "c": ("id string, p bigint, d double, kind string", [("x", 1, 0.0, "k"), ("x", 1, -0.0, None), ("y", 7, 1.5, "k"), (None, None, None, "k"), ("z", 7, 1.5, "m")]),
        "e": ("p bigint", []),
    }
    tables = {}
    for name, (ddl, own) in rows.items():
        spark.createDataFrame(own, ddl).repartition(3).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    contracts = {
        quality.NotNull("p", "id"): 1, quality.Unique("p", "id"): 1, quality.NotNull("p", "name"): 1, quality.Unique("p", "name"): 1,
        quality.NotNull("c", "id"): 1, quality.Unique("c", "id"): 1, quality.Unique("c", "d"): 2, quality.NotNull("c", "kind"): 1,
        quality.Relationship("c", "p", "p", "id"): 2, quality.Relationship("c", "p", "p", "id", True): 3,
        quality.Relationship("c", "p", "p", "id", True, "kind = 'k'"): 2, quality.Relationship("p", "id", "c", "p"): 3,
        quality.Relationship("c", "p", "e", "p"): 4, quality.Relationship("e", "p", "p", "id", True): 0, quality.Unique("e", "p"): 0,
        quality.Rule("c", "kind", "named", "kind = 'k' AND p > 1"): 1,
    }
    results = quality.run_contracts(tables, contracts)
    assert [r.failing_rows for r in results.collect()] == list(contracts.values())
    plan = results._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 3 and "Join" not in plan
