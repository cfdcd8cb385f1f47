"""Landing a stream of records as JSON-lines files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.sources.files import CORRUPT
from ledgerloom.sources.kafka import decode

# The flush rule, ten records or ten seconds, whichever comes first. A topic is read by that rule itself
# (``kafka.read_topic`` with ``flush_records``); files are flushed on the time trigger and bounded by their number.
FLUSH_RECORDS = 10
FLUSH_SECONDS = 10


def read_landing(
    spark: SparkSession,
    path: str,
    schema: str,
    max_files: int | None = None,
    keep_corrupt: bool = False,
    archive: str | None = None,
) -> DataFrame:
    """Landed JSON-lines files as a stream; ``max_files`` bounds each micro-batch.

    With ``archive`` files whose batch is done are moved there.
    """
    reader = spark.readStream.schema(f"{schema}, {CORRUPT} string" if keep_corrupt else schema)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def land(
    records: DataFrame, path: str, checkpoint: str, drain: bool = False, seconds: int = FLUSH_SECONDS
) -> StreamingQuery:
    """Write a stream as JSON lines, exactly once per checkpoint.

    Progress is the checkpoint, not a consumer group, so a crash loses nothing that was read. With
    ``drain`` the query takes everything available and stops; otherwise it runs until it is stopped.
    """
    writer = (
        records.writeStream.format("json")
        .option("ignoreNullFields", "false")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if drain else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def land_topic(
    messages: DataFrame, schema: str, path: str, rejects: str, state: str, drain: bool = False, seconds: int = FLUSH_SECONDS
) -> tuple[StreamingQuery, StreamingQuery]:
    """Keyed messages to JSON lines: readable values below ``path``, the text of the others below ``rejects``.

    ``messages`` has the columns of a topic, ``key`` and ``value``. Each side keeps its own progress below ``state``.
    """
    records, unreadable = decode(messages, schema), F.col(CORRUPT).isNotNull()
    return (
        land(records.filter(~unreadable).drop(CORRUPT), path, f"{state}/records", drain, seconds),
        land(records.filter(unreadable).select(F.col(CORRUPT).alias("value")), rejects, f"{state}/rejects", drain, seconds),
    )
