"""Streams, replayed from the test tables as landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.upsert import one_per_key
from ledgerloom.plans import lakehouse
from ledgerloom.queries import Registry
from ledgerloom.queries.loading import EVENTS_JSON, STREAM, new_lake, text_times
from ledgerloom.queries.standins import raw, table
from ledgerloom.sources import kafka
from ledgerloom.sources.files import scan_jsonl, write_jsonl
from ledgerloom.streaming import bronze, landing

REGISTRY = Registry({}, {})
query = REGISTRY.add


@query("stream_land_jsonl", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_land_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, "land")
    write_jsonl(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string")), f"{lake.root}/in")
    source = landing.read_landing(spark, f"{lake.root}/in", EVENTS_JSON)
    landing.land(source, f"{lake.root}/out", f"{lake.root}/progress", drain=True).awaitTermination()
    return scan_jsonl(spark, f"{lake.root}/out", EVENTS_JSON).withColumn("ts", F.col("ts").try_cast("timestamp_ntz"))


def land_files(records: DataFrame, path: str) -> int:
    """Land records as JSON files, four for each part of the scan, so that none grows with the table; returns how many were asked for."""
    files = 4 * records.rdd.getNumPartitions()
    write_jsonl(text_times(records).repartition(files), path)
    return files


@query("stream_bronze", "SELECT transaction_id, account_id, count(*) AS rows FROM "
       "(SELECT DISTINCT transaction_id, account_id FROM raw_transactions) GROUP BY ALL")
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions arrive as files, half of them in a micro-batch; the ones before 1999 are in Bronze already.

    The load is started twice from one checkpoint. Which copy of a repeated id stays depends on the
    order of the files, so only ids are returned.
    """
    lake = new_lake(spark, "stream")
    arriving = raw(spark, sf_dir, "transactions")
    files = land_files(arriving, f"{lake.root}/in")
    landed = scan_jsonl(spark, f"{lake.root}/in", STREAM)
    present = bronze.typed_transactions(landed).filter(F.col("transaction_timestamp") < "1999-01-01")
    lake.replace("bronze", "transactions", one_per_key(present, "transaction_id", on_duplicate="latest"))
    for _ in range(2):
        source = landing.read_landing(spark, f"{lake.root}/in", STREAM, max_files=files // 2, keep_corrupt=True)
        bronze.load_stream(
            lake,
            bronze.typed_transactions(source),
            "transactions",
            "transaction_id",
            f"{lake.root}/progress",
            f"{lake.root}/rejects",
            ["transaction_timestamp"],
        ).awaitTermination()
    loaded = lake.read("bronze", "transactions")
    return loaded.groupBy("transaction_id", "account_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "bronze_reload_after_stream",
    "SELECT transaction_id, greatest(count(*) FILTER (transaction_timestamp < TIMESTAMP '1999-01-01'), 1) AS rows "
    "FROM raw_transactions GROUP BY transaction_id",
)
def bronze_reload_after_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch, stream, the same batch again, and a stream with nothing new: streamed rows stay, once each."""
    lake = new_lake(spark, "reload")
    arriving = raw(spark, sf_dir, "transactions")
    arriving.filter(F.col("transaction_timestamp") < "1999-01-01").write.parquet(f"{lake.root}/raw/transactions")
    land_files(arriving, f"{lake.root}/in")
    for _ in range(2):
        lakehouse.load_bronze(lake, f"{lake.root}/raw", "transactions")
        records = bronze.typed_transactions(landing.read_landing(spark, f"{lake.root}/in", STREAM, keep_corrupt=True))
        folders = f"{lake.root}/progress", f"{lake.root}/rejects"
        bronze.load_stream(lake, records, "transactions", "transaction_id", *folders, ["transaction_timestamp"]).awaitTermination()
    return lake.read("bronze", "transactions").groupBy("transaction_id").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "topic_to_landing",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 5 <> 0 "
    "UNION ALL SELECT event_id, NULL, NULL, NULL FROM events WHERE event_id % 5 = 0",
)
def topic_to_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth message is cut short and lands among the rejects, where its id can still be read."""
    lake = new_lake(spark, "topic")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    text = F.col("value").cast("string")
    cut = F.when(F.get_json_object(text, "$.event_id").cast("bigint") % 5 == 0, F.substring_index(text, ",", 1)).otherwise(text)
    kafka.encode(events, "event_id").select("key", cut.cast("binary").alias("value")).write.parquet(f"{lake.root}/topic")
    messages = spark.readStream.schema("key binary, value binary").parquet(f"{lake.root}/topic")
    for running in landing.land_topic(messages, EVENTS_JSON, f"{lake.root}/landed", f"{lake.root}/rejects", f"{lake.root}/state", drain=True):
        running.awaitTermination()
    landed = scan_jsonl(spark, f"{lake.root}/landed", EVENTS_JSON).select("event_id", "user_id", "event_type", "value")
    rejected = scan_jsonl(spark, f"{lake.root}/rejects", "value string")
    number = F.regexp_extract("value", r'^\{"event_id":(\d+)$', 1).cast("bigint").alias("event_id")
    return landed.unionByName(rejected.select(number), allowMissingColumns=True)
