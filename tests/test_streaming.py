from __future__ import annotations

import json
from contextlib import redirect_stdout
from io import StringIO
from pathlib import Path

from pyspark.sql import functions as F

from ledgerloom.queries.streams import land_files
from ledgerloom.schemas import STREAM_TRANSACTION
from ledgerloom.streaming import bronze, landing
from ledgerloom.streaming.key_index import KeyIndex
from tests.conftest import values


def record(number: int, **changes) -> str:
    row = {
        "transaction_id": f"stream_txn_{number:012d}",
        "account_id": "acc_00000001",
        "merchant_id": None,
        "transaction_timestamp": "2024-03-05T10:00:00.123456+00:00",
        "transaction_type": "deposit",
        "amount": 10.0 + number,
        "currency": "INR",
        "transaction_status": "completed",
        "payment_method": "upi",
        "description": "d",
    }
    return json.dumps({**row, **changes}, separators=(",", ":"))


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def load(spark, lake, tmp_path, progress="progress"):
    source = landing.read_landing(spark, str(tmp_path / "in"), STREAM_TRANSACTION, max_files=1, keep_corrupt=True)
    bronze.load_stream(
        lake,
        bronze.typed_transactions(source),
        "transactions",
        "transaction_id",
        str(tmp_path / progress),
        str(tmp_path / "rejects" / progress),
        ["transaction_timestamp"],
    ).awaitTermination()


def ids(lake):
    return [r[0][-1] for r in values(lake.read("bronze", "transactions"), "transaction_id")]


def test_bronze_load_restart_and_replay(spark, lake, tmp_path):
    put(tmp_path / "in", "a.jsonl", record(1), record(2), record(2, description="again"), '{"transaction_id": "cut')
    put(tmp_path / "in", "b.jsonl", record(2, description="later"), record(3), record(9, transaction_id=None))
    load(spark, lake, tmp_path)
    assert ids(lake) == ["1", "2", "3"]
    load(spark, lake, tmp_path)
    assert ids(lake) == ["1", "2", "3"]
    put(tmp_path / "in", "c.jsonl", record(4), record(1))
    load(spark, lake, tmp_path)
    assert ids(lake) == ["1", "2", "3", "4"]
    load(spark, lake, tmp_path, "new_progress")
    assert ids(lake) == ["1", "2", "3", "4"]
    rejects = spark.read.parquet(str(tmp_path / "rejects" / "progress"))
    assert rejects.count() == 2
    assert rejects.filter("_corrupt_record is not null").count() == 1
    first = lake.read("bronze", "transactions").filter("transaction_id like '%01'").first()
    assert first.transaction_timestamp.microsecond == 123456 and first._source_file.endswith("a.jsonl")
    assert dict(lake.read("bronze", "transactions").dtypes)["merchant_id"] == "string"


def test_a_new_checkpoint_keeps_the_older_rejects(spark, lake, tmp_path):
    put(tmp_path / "in", "a.jsonl", record(1), '{"transaction_id": "cut')
    source = lambda: landing.read_landing(spark, str(tmp_path / "in"), STREAM_TRANSACTION, keep_corrupt=True)
    for progress in ("one", "two"):
        bronze.load_stream(
            lake, bronze.typed_transactions(source()), "transactions", "transaction_id", str(tmp_path / progress), str(tmp_path / "rejects")
        ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2
    assert len(list((tmp_path / "rejects").iterdir())) == 2


def test_topic_to_landing(spark, tmp_path):
    """A table of keyed messages stands for the topic."""
    rows = [(b"1", record(1).encode()), (b"2", b'{"transaction_id": "cut'), (b"3", record(3).encode()), (b"4", b"\xff\xfe")]
    topic = str(tmp_path / "topic")
    spark.createDataFrame(rows, "key binary, value binary").write.parquet(topic)
    out, rejects, state = (str(tmp_path / n) for n in ("out", "rejects", "state"))
    for _ in range(2):
        messages = spark.readStream.schema("key binary, value binary").parquet(topic)
        for running in landing.land_topic(messages, STREAM_TRANSACTION, out, rejects, state, drain=True):
            running.awaitTermination()
    assert spark.read.schema(STREAM_TRANSACTION).json(out).count() == 2
    kept = [r.value for r in spark.read.schema("value string").json(rejects).collect()]
    assert len(kept) == 2 and '{"transaction_id": "cut' in kept


def test_absent_rows_keeps_one_row_per_key(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "k string, v int")
    target = spark.createDataFrame([("b", 0), ("z", 0), (None, 0)], "k string, v int")
    assert values(bronze.absent_rows(batch, target, "k", ["v"])) == [("a", 2)]


def test_landing_is_exactly_once(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", record(1), record(2))
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")

    def drain():
        source = landing.read_landing(spark, str(tmp_path / "in"), STREAM_TRANSACTION)
        landing.land(source, out, progress, drain=True).awaitTermination()
        return spark.read.schema(STREAM_TRANSACTION).json(out)

    assert drain().count() == 2
    put(tmp_path / "in", "b.jsonl", record(3))
    assert drain().count() == 3
    assert drain().filter("merchant_id is null").count() == 3


def test_running_query_flushes_on_time_and_stops(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", record(1))
    source = landing.read_landing(spark, str(tmp_path / "in"), STREAM_TRANSACTION)
    query = landing.land(source, str(tmp_path / "out"), str(tmp_path / "progress"), seconds=1)
    query.processAllAvailable()
    query.stop()
    assert not query.isActive
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_bounded_dedupe(spark, tmp_path):
    put(tmp_path / "in", "a.jsonl", record(1), record(1), record(2))
    source = landing.read_landing(spark, str(tmp_path / "in"), STREAM_TRANSACTION)
    timed = source.withColumn("transaction_timestamp", F.col("transaction_timestamp").try_cast("timestamp"))
    unique = bronze.drop_recent_duplicates(timed, "transaction_id", "transaction_timestamp")
    landing.land(unique, str(tmp_path / "out"), str(tmp_path / "progress"), drain=True).awaitTermination()
    assert spark.read.json(str(tmp_path / "out")).count() == 2


def test_key_index_reads_the_buckets_of_a_batch(spark, lake):
    """Only the folders that the batch's keys fall into are scanned; a missing bucket of the table is no error."""
    schema = "k string, v int"
    lake.replace("bronze", "t", spark.createDataFrame([(f"k{i}", i) for i in range(300)] + [(None, 1), ("k5", 9)], schema))
    index = KeyIndex(lake, "bronze", "t", "k", 16)
    batch = spark.createDataFrame([("k7", 0), ("new", 0)], schema)
    known = index.known(batch)
    assert values(known) == [("k7",)]
    buckets = sorted(r[0] for r in batch.select(index.bucket(F.col("k"))).distinct().collect())
    with redirect_stdout(StringIO()) as out:
        known.explain("formatted")
    text = " ".join(out.getvalue().split())
    assert "PartitionFilters: [bucket#" in text and f"IN ({','.join(map(str, buckets))})" in text
    folders = {p.name for p in Path(index.root.removeprefix("file:")).glob("keys/bucket=*")}
    assert len(folders) == 16
    bulk = spark.createDataFrame([(f"k{i}", 0) for i in range(250, 350)], schema)
    scanned = index.known(bulk)
    assert len(values(scanned)) == 50
    with redirect_stdout(StringIO()) as out:
        scanned.explain("formatted")
    assert "bucket#" not in out.getvalue() and "ReadSchema: struct<k:string>" in out.getvalue()


def test_key_index_follows_appends_and_new_snapshots(spark, lake):
    schema = "k string, v int"
    insert = lambda rows: bronze.insert_if_absent(lake, "bronze", "t", spark.createDataFrame(rows, schema), "k")
    insert([("a", 1), ("b", 1), (None, 1)])
    insert([("a", 2), ("c", 2)])
    index = KeyIndex(lake, "bronze", "t", "k")
    assert len(index.refresh()) > 0 and index.refresh() == []
    # Rows that came without their entries, as after a load that died between the two.
    lake.append("bronze", "t", spark.createDataFrame([("d", 3)], schema))
    insert([("d", 4), ("e", 4), ("e", 5)])
    insert([("d", 4), ("e", 4)])
    assert values(lake.read("bronze", "t")) == [("a", 1), ("b", 1), ("c", 2), ("d", 3), ("e", 5)]
    lake.replace("bronze", "t", lake.read("bronze", "t").filter("k > 'b'"))
    insert([("a", 7), ("c", 7)])
    assert values(lake.read("bronze", "t"), "k") == [("a",), ("c",), ("d",), ("e",)]
    assert KeyIndex(lake, "bronze", "t", "k").root != index.root
    empty = spark.createDataFrame([], schema)
    assert KeyIndex(lake, "bronze", "t", "k").known(empty).collect() == []


def test_landed_files_follow_the_parts_of_the_scan(spark, tmp_path):
    """A fixed number of files let the part that one task shuffles and writes grow with the table."""
    written = {}
    for parts in (1, 10):
        rows = spark.range(0, 4000, 1, parts).select(F.col("id").cast("string").alias("transaction_id"), F.timestamp_seconds("id").alias("transaction_timestamp"))
        assert land_files(rows, str(tmp_path / f"in{parts}")) == 4 * parts
        written[parts] = list((tmp_path / f"in{parts}").glob("*.json"))
        found = spark.read.schema("transaction_id string, transaction_timestamp string").json(str(tmp_path / f"in{parts}"))
        assert values(found, "transaction_id") == sorted((str(i),) for i in range(4000))
    assert len(written[1]) == 4 and len(written[10]) == 40
