"""Incremental load of landed records into a Bronze table, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.upsert import one_per_key
from ledgerloom.schemas import RAW, STAMP_COLUMNS, ddl_columns
from ledgerloom.sources.files import CORRUPT, below, stamp
from ledgerloom.sources.lake import Lake
from ledgerloom.streaming.key_index import KeyIndex


def typed_transactions(records: DataFrame) -> DataFrame:
    """Stream or batch of landed transactions in Bronze form; a bad time becomes null."""
    stamped = stamp(records).withColumn("transaction_timestamp", F.col("transaction_timestamp").try_cast("timestamp"))
    extra = [CORRUPT] if CORRUPT in records.columns else []
    return stamped.select(*ddl_columns(RAW["transactions"]), *STAMP_COLUMNS, *extra)


def absent_rows(batch: DataFrame, target: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Batch rows whose key the target lacks, one row per key."""
    return _without(one_per_key(batch.filter(F.col(key).isNotNull()), key, order, "latest"), target, key).select(*batch.columns)


def _without(fresh: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of a batch with one row per key whose key the target lacks.

    The target is first reduced to the keys of the batch. While those keys fit a broadcast join the target's key column
    is only scanned, never shuffled, and what follows is batch-sized.
    """
    known = target.select(key).join(fresh.select(key), key, "left_semi")
    return fresh.join(known, key, "left_anti")


def insert_if_absent(
    lake: Lake, layer: str, table: str, batch: DataFrame, key: str, order: list[str] | None = None
) -> None:
    """Append the rows whose key is new. A replayed batch finds its keys present and adds nothing.

    Which keys are present is read from the buckets of a key index that the batch falls into, not from the table.
    """
    # Asked for twice, and an aggregation of the batch: kept while the batch is loaded.
    fresh = one_per_key(batch.filter(F.col(key).isNotNull()), key, order, "latest").select(*batch.columns).persist()
    if lake.exists(layer, table):
        known = KeyIndex(lake, layer, table, key).known(fresh)
        lake.append(layer, table, fresh.join(known, key, "left_anti").select(*batch.columns))
    else:
        lake.append(layer, table, fresh)
    fresh.unpersist()


def with_streamed(lake: Lake, table: str, batch: DataFrame, folder: str, key: str) -> DataFrame:
    """A batch load of ``folder`` beside the Bronze rows that came in another way and whose key the batch lacks."""
    if not lake.exists("bronze", table):
        return batch
    streamed = lake.read("bronze", table).filter(~F.coalesce(below(folder), F.lit(False)))  # rows without source file stay
    return batch.unionByName(absent_rows(streamed, batch, key), allowMissingColumns=True)


def load_stream(
    lake: Lake,
    records: DataFrame,
    table: str,
    key: str,
    checkpoint: str,
    rejects: str,
    order: list[str] | None = None,
) -> StreamingQuery:
    """Drain the stream into ``bronze.<table>``; unreadable and keyless rows go to ``rejects``.

    Rejects are kept per query and batch id: a replayed batch overwrites its own rejects, and a load that starts anew
    from another checkpoint is another query.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        bad = F.col(key).isNull()
        if CORRUPT in batch.columns:
            bad = bad | F.col(CORRUPT).isNotNull()
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.filter(bad).write.mode("overwrite").parquet(f"{rejects}/query_id={query}/batch_id={batch_id}")
        insert_if_absent(lake, "bronze", table, batch.filter(~bad).drop(CORRUPT), key, order)
        batch.unpersist()

    return (
        records.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_recent_duplicates(stream: DataFrame, key: str, event_time: str, delay: str = "1 hour") -> DataFrame:
    """Optional bounded dedupe: repeats of a key within ``delay`` of event time are dropped.

    State is bounded by the watermark, so a repeat that arrives later than that passes.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
