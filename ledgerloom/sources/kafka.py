"""Kafka as a source and sink of keyed JSON records.

Encoding and decoding are column expressions, so the same code serves a Kafka stream, a batch
read, and any table with binary ``key`` / ``value`` columns. The connector package is not part of
a plain Spark install; add it to the session to use :func:`read_topic` and :func:`write_topic`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.files import CORRUPT

# Delivery settings of the producer.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "5"}


def encode(df: DataFrame, key: str) -> DataFrame:
    """(key, value) in binary: the key column as text, the whole row as compact JSON."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"), row.cast("binary").alias("value")
    )


def decode(df: DataFrame, schema: str) -> DataFrame:
    """Columns of the JSON value; of a value that does not parse ``_corrupt_record`` has the text."""
    parsed = F.from_json(F.col("value").cast("string"), f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return df.select(parsed.alias("record")).select("record.*")


def topic_options(
    servers: str, topic: str, group: str | None = None, max_records: int | None = None, flush_records: int | None = None, flush_seconds: int | None = None
) -> dict[str, str]:
    """Reader options of a topic from the earliest offset.

    ``max_records`` bounds a micro-batch. With ``flush_records`` one starts as soon as so many records wait, or when
    ``flush_seconds`` have passed since the last one, whichever comes first; the trigger must then be shorter than that.
    """
    if (flush_records is None) != (flush_seconds is None):
        raise ValueError("flush_records and flush_seconds belong together")
    if flush_records and max_records and max_records < flush_records:
        raise ValueError(f"a batch of at most {max_records} records never reaches {flush_records}")
    found = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.group.id": group,
        "maxOffsetsPerTrigger": max_records,
        "minOffsetsPerTrigger": flush_records,
        "maxTriggerDelay": f"{flush_seconds}s" if flush_seconds else None,
    }
    return {name: str(value) for name, value in found.items() if value is not None}


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    group: str | None = None,
    max_records: int | None = None,
    flush_records: int | None = None,
    flush_seconds: int | None = None,
) -> DataFrame:
    """Topic as a stream; see :func:`topic_options`."""
    options = topic_options(servers, topic, group, max_records, flush_records, flush_seconds)
    return spark.readStream.format("kafka").options(**options).load()


def write_topic(df: DataFrame, servers: str, topic: str, key: str) -> None:
    """Batch publish of ``df`` keyed by ``key``."""
    (
        encode(df, key)
        .write.format("kafka")
        .options(**PRODUCER_OPTIONS)
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
