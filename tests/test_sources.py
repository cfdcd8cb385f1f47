from __future__ import annotations

import datetime as dt
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.queries.loading import kafka_rejects
from ledgerloom.schemas import RAW, ddl_columns, layer_name
from ledgerloom.sources import files, kafka
from ledgerloom.streaming.landing import FLUSH_RECORDS, FLUSH_SECONDS
from ledgerloom.sources.lake import load_tables
from tests.conftest import values


def test_jsonl_round_trip_keeps_null_fields(spark, raw_tables, tmp_path):
    path = str(tmp_path / "json")
    files.write_jsonl(raw_tables["accounts"], path)
    line = next(p for p in Path(path).glob("*.json")).read_text().splitlines()[0]
    assert set(json.loads(line)) == set(raw_tables["accounts"].columns)
    assert values(files.scan_jsonl(spark, path, RAW["accounts"])) == values(raw_tables["accounts"])


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1, "b": null}\n{"a": broken\n')
    df = files.scan_jsonl(spark, str(tmp_path), "a int, b string", keep_corrupt=True)
    assert values(df) == [(None, None, '{"a": broken'), (1, None, None)]


def test_landing_gate(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.require_landed(spark, str(tmp_path), "*.json")
    for i in range(12):
        (tmp_path / f"f{i:02d}.json").write_text("x" * i)
    last = files.require_landed(spark, str(tmp_path), "*.json").collect()
    assert len(last) == 10 and last[0].path.endswith("f11.json") and last[0].length == 11


def test_kafka_round_trip(spark, raw_tables):
    messages = kafka.encode(raw_tables["transactions"], "transaction_id")
    assert messages.dtypes == [("key", "binary"), ("value", "binary")]
    first = json.loads(bytes(messages.filter("cast(key as string) = 't2'").first().value))
    assert first["merchant_id"] is None and first["amount"] == 2.675
    decoded = kafka.decode(messages, RAW["transactions"])
    assert values(decoded.drop(files.CORRUPT)) == values(raw_tables["transactions"])
    assert decoded.filter(F.col(files.CORRUPT).isNotNull()).count() == 0
    broken = spark.createDataFrame([(b"k", b"{oops"), (b"k", b'{"a":1}'), (b"k", None)], "key binary, value binary")
    assert values(kafka.decode(broken, "a int")) == [(None, None), (None, "{oops"), (1, None)]


def test_a_rejected_message_is_made_and_parsed_once(spark, sf_dir):
    """The filter on the decoded text, moved below the parsing, made and parsed each message again."""
    plan = kafka_rejects(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and len(re.findall("to_json|StructsToJson", plan)) == 1


def test_drifted_files(spark, lake, raw_tables, tmp_path):
    path = str(tmp_path / "customers")
    drifted = raw_tables["customers"].withColumn("loyalty", F.lit(7)).withColumn("phone", F.lit(12))
    drifted.write.parquet(path)
    found = files.scan_parquet(spark, path, RAW["customers"])
    assert found.columns[-1] == "loyalty" and found.filter("email IS NOT NULL AND loyalty = 7").count() == 2
    report = load_tables(lake, "bronze", {"customers": lambda: files.stamp(found)}, declared=RAW).first()
    assert (report.status, report.drift) == ("loaded", "added: loyalty; retyped: phone string -> int")
    drifted.withColumnRenamed("email", "mail").write.mode("overwrite").parquet(path)
    with pytest.raises(ValueError, match="no column email"):
        files.scan_parquet(spark, path, RAW["customers"])
    readers = {"customers": lambda: files.scan_parquet(spark, path, RAW["customers"])}
    report = load_tables(lake, "bronze", readers, fail=False, declared=RAW).first()
    assert report.status == "failed" and "email" in report.error and lake.read("bronze", "customers").count() == 3


def test_one_renamed_file_of_many_fails_the_load_and_is_named(spark, lake, raw_tables, tmp_path):
    path, rows = str(tmp_path / "customers"), raw_tables["customers"].coalesce(1)
    for part in (rows, rows, rows.withColumnRenamed("email", "mail"), rows.withColumn("loyalty", F.lit(1))):
        part.write.mode("append").parquet(path)
    kinds = files.file_drift(spark, path, RAW["customers"])
    assert values(kinds, "files", "missing", "added", "retyped") == [(1, ["email"], ["mail"], []), (1, [], ["loyalty"], []), (2, [], [], [])]
    renamed = next(f for f in (tmp_path / "customers").glob("*.parquet") if "mail" in spark.read.parquet(str(f)).columns)
    with pytest.raises(ValueError, match=f"no column email in 1 of 4 file.*{renamed.name}"):
        files.scan_parquet(spark, path, RAW["customers"])
    report = load_tables(lake, "bronze", {"customers": lambda: files.scan_parquet(spark, path, RAW["customers"])}, fail=False).first()
    assert report.status == "failed" and renamed.name in report.error
    renamed.unlink()
    found = files.scan_parquet(spark, path, RAW["customers"])
    assert found.count() == 9 and found.filter("loyalty = 1").count() == 3


def test_footers_of_files_that_spark_did_not_write(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": [1], "b": [[1.5]], "c": ["x"]}), tmp_path / "one.parquet")
    expected = [[("a", "bigint"), ("b", "array<double>"), ("c", "string")]]
    for whole in (False, True):
        if whole:  # a file system that Arrow does not know
            real = files.landing_inventory
            monkeypatch.setattr(files, "landing_inventory", lambda *a: real(*a).withColumn("path", F.regexp_replace("path", "^file", "other")))
        rows = files.file_schemas(spark, str(tmp_path)).collect()
        assert [[tuple(c) for c in r.columns] for r in rows] == expected


def test_files_below_a_folder(spark):
    rows = [("file:///tmp/a/raw/t/x.parquet",), ("s3://b/raw/t/y",), ("file:/tmp/a/raw/t2/x",), ("file:///tmp/a%20b+c/t/x",)]
    df = spark.createDataFrame(rows, "_source_file string")
    for folder, expected in (("/tmp/a/raw/t", 1), ("file:///tmp/a/raw/t/", 1), ("s3://b/raw", 1), ("/tmp/a b+c/t", 1), ("/tmp/a", 2)):
        assert df.filter(files.below(folder)).count() == expected, folder


def test_replace_from_itself_and_schema_change(spark, lake):
    lake.replace("silver", "t", spark.range(5))
    before = lake.read("silver", "t")
    lake.replace("silver", "t", before.filter("id > 1"))
    assert lake.read("silver", "t").count() == 3
    lake.replace("silver", "t", lake.read("silver", "t").withColumn("x", F.lit("a")))
    assert lake.read("silver", "t").columns == ["id", "x"]


def test_append_matches_names(spark, lake):
    rows = spark.range(2).selectExpr("id", "cast(id as string) as name")
    lake.append("bronze", "t", rows)
    lake.append("bronze", "t", rows.select("name", "id"))
    assert values(lake.read("bronze", "t")) == [(0, "0"), (0, "0"), (1, "1"), (1, "1")]
    with pytest.raises(ValueError):
        lake.append("bronze", "t", rows.drop("name"))


def test_load_report(spark, lake, sf_dir):
    readers = {n: lambda n=n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("nation", "missing", "region")}
    report = load_tables(lake, "bronze", readers, fail=False)
    assert values(report, "table", "rows", "status") == [("missing", 0, "failed"), ("nation", 25, "loaded"), ("region", 5, "loaded")]
    assert values(load_tables(lake, "bronze", readers, only="nation"), "table") == [("nation",)]
    with pytest.raises(RuntimeError, match="1 table"):
        load_tables(lake, "bronze", readers)
    with pytest.raises(ValueError):
        load_tables(lake, "bronze", readers, only="unknown")


def test_layer_names():
    assert layer_name(None, "gold") == "gold" and layer_name(" marts ", "gold") == "marts"
    assert ddl_columns(RAW["transactions"])[4] == "transaction_type"


def checkpoint_dir(monkeypatch, spark, path):
    real = type(spark.conf).get
    monkeypatch.setattr(
        type(spark.conf), "get", lambda self, key, *rest: path if key == "spark.checkpoint.dir" else real(self, key, *rest)
    )


def test_scratch_follows_the_session(spark, monkeypatch):
    checkpoint_dir(monkeypatch, spark, "/shared/x/")
    assert session.scratch_dir(spark, "a").startswith("/shared/x/a-")


def test_local_scratch_where_nothing_is_set(spark, monkeypatch):
    checkpoint_dir(monkeypatch, spark, None)
    assert session.scratch_base(spark) == session.scratch_base(spark)
    assert session.scratch_base(spark).startswith("/tmp/run-")


def test_no_local_scratch_on_a_cluster(spark, monkeypatch):
    checkpoint_dir(monkeypatch, spark, None)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_base(spark)


def test_a_topic_flushes_by_records_or_time():
    found = kafka.topic_options("host:1", "t", "g", 500, FLUSH_RECORDS, FLUSH_SECONDS)
    assert found == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "t", "startingOffsets": "earliest", "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "500", "minOffsetsPerTrigger": "10", "maxTriggerDelay": "10s",
    }
    assert set(kafka.topic_options("host:1", "t")) == {"kafka.bootstrap.servers", "subscribe", "startingOffsets"}
    for wrong in ({"flush_records": 10}, {"flush_seconds": 10}, {"max_records": 5, "flush_records": 10, "flush_seconds": 1}):
        with pytest.raises(ValueError):
            kafka.topic_options("host:1", "t", **wrong)


def test_expiry_spares_readers_and_current_folders(spark, lake):
    hour, now = dt.timedelta(hours=1), dt.datetime.now(dt.timezone.utc)
    lake.replace("gold", "d", spark.range(10).selectExpr("id AS k", "'a' AS v").repartitionByRange(2, "k"))
    first = lake.read("gold", "d")
    lake.replace("gold", "d", spark.range(10).selectExpr("id AS k", "'b' AS v").repartitionByRange(2, "k"))
    second = lake.read("gold", "d")
    lake.merge("gold", "d", spark.createDataFrame([(3, "c")], "k long, v string"), "k")
    assert sorted(r.current for r in lake.stored_folders("gold", "d").collect()) == [False, True, True]
    assert lake.expire("gold", "d", hour, now) == []  # all too young
    assert first.count() == second.count() == 10
    gone = lake.expire("gold", "d", hour, now + 2 * hour)
    assert len(gone) == 1 and gone[0].startswith("snapshot=")
    assert second.filter("v = 'b'").count() == 10  # a reader of files that a merge superseded
    assert lake.read("gold", "d").count() == 10 and lake.read("gold", "d").filter("v = 'c'").count() == 1
    with pytest.raises(ValueError):
        lake.expire("gold", "d", dt.timedelta(0))
