"""Incremental selection and keyed upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOOKBACK = "1 day"
EPOCH = "1900-01-01 00:00:00"


def cutoff(target: DataFrame, updated_at: str = "updated_at", lookback: str = LOOKBACK) -> DataFrame:
    """One row: latest ``updated_at`` of the target minus the look-back.

    An empty target counts as 1900-01-01, so every dated source row is taken.
    """
    latest = F.coalesce(F.max(updated_at), F.lit(EPOCH).cast(target.schema[updated_at].dataType))
    return target.agg((latest - F.expr(f"INTERVAL {lookback}")).alias("cutoff"))


def changed_rows(
    source: DataFrame, target: DataFrame, updated_at: str = "updated_at", lookback: str = LOOKBACK
) -> DataFrame:
    """Source rows at or after the cutoff; null ``updated_at`` never passes.

    The cutoff is a scalar subquery: it runs once, and its value becomes a filter of the scan.
    """
    return source.filter(F.col(updated_at) >= cutoff(target, updated_at, lookback).scalar())


def changed_rows_sql(
    source: DataFrame, target: DataFrame, updated_at: str = "updated_at", lookback: str = LOOKBACK
) -> DataFrame:
    """:func:`changed_rows` written as SQL text, for models kept as SQL files."""
    return source.sparkSession.sql(
        f"""
        SELECT * FROM {{source}}
        WHERE {updated_at} >= (
            SELECT coalesce(max({updated_at}), TIMESTAMP '{EPOCH}') - INTERVAL {lookback} FROM {{target}}
        )
        """,
        source=source,
        target=target,
    )


def one_per_key(
    changes: DataFrame, key: str, order: list[str] | None = None, on_duplicate: str = "error"
) -> DataFrame:
    """At most one row per non-null key; rows with a null key all stay.

    ``error`` fails the job when a key repeats, ``latest`` keeps its greatest row by ``order`` with
    all columns as the tie-break. It is one aggregation that keeps a single row per key on the map
    side, so a key with very many rows needs no sort of its group in one task.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    columns = changes.columns
    first = [c for c in order or [] if c != key]
    rest = [c for c in columns if c != key and c not in first]
    greatest: Column = F.max(F.struct(*[F.col(c) for c in first + rest]))
    kept = changes.filter(F.col(key).isNotNull()).groupBy(key).agg(greatest.alias("__row"), F.count(F.lit(1)).alias("__n"))
    if on_duplicate == "error":
        message = F.concat(F.lit(f"more than one source row for {key} = "), F.col(key).cast("string"))
        checked = F.when(F.col("__n") > 1, F.raise_error(message).cast(kept.schema[key].dataType)).otherwise(F.col(key))
        kept = kept.withColumn(key, checked)
    unkeyed = changes.filter(F.col(key).isNull())
    return kept.select(key, "__row.*").select(*columns).unionByName(unkeyed)


def upsert(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    order: list[str] | None = None,
    on_duplicate: str = "error",
) -> DataFrame:
    """Target after the merge: rows with a matching key replaced, others inserted, none deleted.

    A null key never matches, so such change rows are inserted every time. Target rows without a key
    bypass the join; in it, they would all meet in one task.
    """
    fresh = one_per_key(changes, key, order, on_duplicate).select(*target.columns)
    keyed, unkeyed = target.filter(F.col(key).isNotNull()), target.filter(F.col(key).isNull())
    kept = keyed.join(fresh.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(unkeyed).unionByName(fresh)


def merge_increment(
    target: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    lookback: str = LOOKBACK,
    on_duplicate: str = "error",
) -> DataFrame:
    """Next state of an incremental table: all source rows on the first run, else an upsert."""
    if target is None:
        return source
    changes = changed_rows(source, target, updated_at, lookback)
    return upsert(target, changes, key, [updated_at], on_duplicate)
