from __future__ import annotations

import datetime as dt
import json
from collections import Counter
from contextlib import redirect_stdout
from io import StringIO
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.features import TooFewRows
from ledgerloom.plans import lakehouse
from ledgerloom.schemas import RAW
from tests.conftest import utc, values


def write_raw(tables, folder):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def test_batch_run_twice(spark, lake, raw_tables, tmp_path):
    raw = str(tmp_path / "raw")
    write_raw(raw_tables, raw)
    first, last = dt.date(2024, 3, 1), dt.date(2024, 3, 31)
    rows = lakehouse.run(lake, raw, first, last).collect()
    results = {(r.check_name, r.table_name, r.column_name): r.failing_rows for r in rows}
    kinds = Counter(r.check_name for r in rows)
    assert kinds.pop("parse_loss") == 5 and kinds.pop("null_count") == sum(len(t.columns) + 2 for t in raw_tables.values())
    assert kinds.total() == 18 + 21
    assert results["null_count", "customers", "email"] == 1
    assert results["unique", "fact_transaction", "transaction_id"] == 1
    assert results["not_null", "fact_transaction", "date_key"] == 2
    assert results["relationship", "dim_account", "customer_id"] == 1
    assert results["relationship", "fact_transaction", "account_id"] == 1
    assert results["not_null", "dim_date", "date_key"] == 0
    assert lake.read("gold", "fact_transaction").count() == 7
    assert lake.read("marts", "daily_transaction_metrics").count() == 31
    assert "_source_file" in lake.read("bronze", "accounts").columns

    changed = raw_tables["accounts"].withColumns(
        {
            "account_status": F.when(F.col("account_id") == "acc_00000001", " CLOSED ").otherwise(F.col("account_status")),
            "updated_at": F.when(F.col("account_id") == "acc_00000001", F.lit(utc("2024-04-01 00:00:00"))).otherwise(
                F.lit(utc("2020-01-01 00:00:00"))
            ),
            "balance": F.lit(1.5),
        }
    )
    write_raw({"accounts": changed}, raw)
    lakehouse.run(lake, raw, first, last)
    accounts = {r.account_id: r for r in lake.read("gold", "dim_account").collect()}
    assert len(accounts) == 4
    assert (accounts["acc_00000001"].account_status, accounts["acc_00000001"].balance) == ("closed", 1.5)
    assert accounts["acc_00000002"].balance == 20.5
    customers = lake.read("gold", "dim_customer")
    assert customers.count() == 3 and customers.filter("updated_at is null").count() == 1
    assert lake.read("bronze", "accounts").count() == 4


def test_stream_run(spark, lake, raw_tables, tmp_path):
    write_raw(raw_tables, str(tmp_path / "raw"))
    lakehouse.load_bronze(lake, str(tmp_path / "raw"))
    landed, state = tmp_path / "landed", str(tmp_path / "state")
    landed.mkdir()
    with pytest.raises(FileNotFoundError):
        lakehouse.run_stream(lake, str(landed), state)
    row = {"transaction_id": "t1", "account_id": "acc_00000001", "transaction_timestamp": "2024-03-08T00:00:00Z", "amount": 1.0}
    lines = [json.dumps({**row, "transaction_id": t}) for t in ("t1", "s1", "s1", "s2")]
    (landed / "a.jsonl").write_text("\n".join(lines))
    for _ in range(2):
        checks = lakehouse.run_stream(lake, str(landed), state)
        found = [r[0] for r in values(lake.read("bronze", "transactions"), "transaction_id")]
        assert found == [None, None, "s1", "s2", "t1", "t2", "t3", "t4", "t4"]
    assert checks.filter("check_name NOT IN ('null_count', 'parse_loss')").count() == 18


def test_streamed_rows_survive_a_batch_reload(spark, lake, raw_tables, tmp_path):
    raw, landed, state = str(tmp_path / "raw"), tmp_path / "landed", str(tmp_path / "state")
    write_raw(raw_tables, raw)
    landed.mkdir()
    row = {"account_id": "acc_00000001", "transaction_timestamp": "2024-03-08T00:00:00Z", "amount": 1.0}
    (landed / "a.jsonl").write_text("\n".join(json.dumps({**row, "transaction_id": f"s{i}"}) for i in range(5)))
    counts = []
    for _ in range(2):
        lakehouse.load_bronze(lake, raw)
        counts.append(lake.read("bronze", "transactions").count())
        lakehouse.run_stream(lake, str(landed), state)
        counts.append(lake.read("bronze", "transactions").count())
    assert counts == [7, 12, 12, 12]
    # A streamed id that the batch brings later is the batch's.
    late = raw_tables["transactions"].limit(1).withColumn("transaction_id", F.lit("s3")).withColumn("amount", F.lit(99.0))
    late.write.mode("append").parquet(f"{raw}/transactions")
    lakehouse.load_bronze(lake, raw, "transactions")
    assert values(lake.read("bronze", "transactions").filter("transaction_id = 's3'"), "amount") == [(99.0,)]
    assert lake.read("bronze", "transactions").count() == 12


def test_landed_files_can_be_archived(spark, lake, raw_tables, tmp_path):
    write_raw(raw_tables, str(tmp_path / "raw"))
    lakehouse.load_bronze(lake, str(tmp_path / "raw"))
    landed, archive = tmp_path / "landed", tmp_path / "archive"
    landed.mkdir()
    for i in range(3):
        (landed / f"{i}.jsonl").write_text(json.dumps({"transaction_id": f"s{i}", "amount": 1.0}))
        lakehouse.run_stream(lake, str(landed), str(tmp_path / "state"), archive=str(archive))
    assert lake.read("bronze", "transactions").count() == 10
    assert len(list(landed.glob("*.jsonl"))) + len(list(archive.rglob("*.jsonl"))) == 3 and list(archive.rglob("*.jsonl"))


def test_detection_run(spark, lake):
    rows = 400
    amount = F.expr("cast(if(id = 7, 90000, 100 + id % 50) as decimal(18,2))")
    facts = spark.range(rows).select(
        F.format_string("t%03d", "id").alias("transaction_id"), F.lit(20240305).alias("date_key"), amount.alias("amount")
    )
    lake.replace("gold", "fact_transaction", facts)
    found = lakehouse.run_detection(lake)
    scored = lake.read("ai", "scored_transactions")
    assert scored.count() == rows
    assert found.count() == scored.filter("is_anomaly").count() >= 1
    incident = found.filter("affected_record = 't007'").first()
    assert incident.transaction_context.startswith("amount = 90000.00")
    assert incident.what_happened == "1 of 1 measured values lie 2 or more standard deviations from normal."
    assert incident.next_step == "Check amount against the account's other records."
    lake.replace("gold", "fact_transaction", facts.limit(9))
    with pytest.raises(TooFewRows):
        lakehouse.run_detection(lake)


def test_raw_schemas_cover_the_lake(raw_tables):
    assert set(RAW) == set(raw_tables)


def stored_files(lake, layer, table):
    """Name and time of each file of the table's rows."""
    names = {r[0] for r in lake._with_files(layer, table).select("__file").distinct().collect()}
    return {p.name: p.stat().st_mtime_ns for p in Path(lake.root, layer, table).rglob("*.parquet") if p.name in names}


def test_merge_writes_only_the_files_that_hold_changed_keys(spark, lake):
    rows = [(i, "old") for i in range(100)] + [(None, "no key")]
    lake.replace("gold", "d", spark.createDataFrame(rows, "k long, v string").repartitionByRange(5, "k"))
    before, old = stored_files(lake, "gold", "d"), lake.read("gold", "d")
    assert lake.merge("gold", "d", spark.createDataFrame([(7, "new"), (1000, "added"), (None, "added")], "k long, v string"), "k") == 1
    after = stored_files(lake, "gold", "d")
    assert len(before.keys() - after.keys()) == 1 and all(after[f] == t for f, t in before.items() if f in after)
    expected = [(None, "added"), (None, "no key")] + [(i, "new" if i == 7 else "old") for i in range(100)] + [(1000, "added")]
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in lake.read("gold", "d").collect()) == order(expected)
    assert sorted(r.v for r in old.collect()).count("new") == 0  # a reader keeps what it had
    # Superseded files are left out by name, for which no row has to be read.
    with redirect_stdout(StringIO()) as out:
        lake.read("gold", "d").explain("formatted")
    assert out.getvalue().count("NOT file_name#") >= 1 or "file_name" in out.getvalue()
    for _ in range(2):  # a second merge over the first; then one that finds nothing to do
        lake.merge("gold", "d", spark.createDataFrame([(7, "newer"), (8, "newer")], "k long, v string"), "k")
    assert lake.read("gold", "d").filter("v = 'newer'").count() == 2 and lake.read("gold", "d").count() == 103
    assert lake.merge("gold", "d", spark.createDataFrame([], "k long, v string"), "k") == 0
    with pytest.raises(Exception, match="more than one source row"):
        lake.merge("gold", "d", spark.createDataFrame([(7, "a"), (7, "b")], "k long, v string"), "k")
    lake.append("gold", "d", spark.createDataFrame([(2000, "appended")], "k long, v string"))
    assert lake.merge("gold", "d", spark.createDataFrame([(2000, "merged")], "k long, v string"), "k") == 1
    assert [r.v for r in lake.read("gold", "d").filter("k = 2000").collect()] == ["merged"]


def test_many_changes_end_in_a_new_snapshot(spark, lake, monkeypatch):
    monkeypatch.setattr("ledgerloom.sources.lake.MAX_FOLDERS", 2)
    lake.replace("gold", "d", spark.range(10).selectExpr("id AS k", "0 AS v"))
    for i in range(4):
        lake.merge("gold", "d", spark.createDataFrame([(i, i + 1), (10 + i, 0)], "k long, v int"), "k")
        assert lake.changed("gold", "d") == (i % 2 == 0)
    assert sorted(tuple(r) for r in lake.read("gold", "d").collect()) == [(i, i + 1 if i < 4 else 0) for i in range(14)]


def test_refresh_of_a_day_leaves_the_others_alone(spark, lake):
    days = spark.createDataFrame([(i, f"2024-01-0{1 + i % 4}") for i in range(40)] + [(99, None)], "k long, day string").withColumn("day", F.to_date("day"))
    lake.replace("bronze", "t", days, ["day"])
    before = stored_files(lake, "bronze", "t")
    again = days.filter("day = DATE '2024-01-02'").withColumn("k", F.col("k") + 1000)
    assert lake.refresh_partitions("bronze", "t", again) >= 1
    after = stored_files(lake, "bronze", "t")
    kept = before.keys() & after.keys()
    assert all(after[f] == before[f] for f in kept) and len(kept) == len(before) - 1
    table = lake.read("bronze", "t")
    assert table.count() == 41 and table.filter("day = DATE '2024-01-02'").agg(F.min("k")).first()[0] == 1001
    with redirect_stdout(StringIO()) as out:
        table.filter("day = DATE '2024-01-03'").explain("formatted")
    assert "PartitionFilters" in out.getvalue() and "2024-01-03" in out.getvalue().split("PartitionFilters")[1].split("]")[0]
    assert lake.refresh_partitions("bronze", "t", days.filter("day IS NULL")) == 1 and lake.read("bronze", "t").count() == 41
    assert lake.refresh_partitions("bronze", "t", days.limit(0)) == 0
    lake.replace("bronze", "u", days)
    with pytest.raises(ValueError, match="no partitions"):
        lake.refresh_partitions("bronze", "u", days)
