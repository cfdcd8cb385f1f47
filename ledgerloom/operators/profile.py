"""Column profiles. Each is one aggregation over one scan, however many columns it covers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import finite, numeric_columns


def _long(row: DataFrame, measures: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One-row frame with columns ``<measure>|<column>`` -> one row per column."""
    entries = ", ".join(f"'{c}', " + ", ".join(f"`{m}|{c}`" for m in measures) for c in columns)
    return row.selectExpr(f"stack({len(columns)}, {entries}) AS (column_name, {', '.join(measures)})")


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_rows) for every column."""
    row = df.selectExpr(*[f"count_if(`{c}` IS NULL) AS `null_rows|{c}`" for c in df.columns])
    return _long(row, ["null_rows"], df.columns)


def null_counts_by(df: DataFrame, group: str, column: str) -> DataFrame:
    """Null rows of one column per value of another."""
    return df.groupBy(group).agg(F.count_if(F.col(column).isNull()).alias("null_rows"))


def value_counts(df: DataFrame, column: str | Column) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def key_report(df: DataFrame, key: str, table: str) -> DataFrame:
    """One row: total, distinct keys, duplicates, null keys, keys that occur more than once.

    All nulls together count as one distinct key in ``distinct_keys``. The rows are first counted
    per key, which the map side combines, so every measure comes from a single shuffle of keys.
    """
    per_key = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    distinct = F.count(F.lit(1))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        total.alias("total_rows"),
        distinct.alias("distinct_keys"),
        (total - distinct).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count_if((F.col("n") > 1) & F.col("key").isNotNull()).alias("repeated_keys"),
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("first_value"), F.max(column).alias("last_value"))


def shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns and numeric columns of the dataset."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(len(numeric_columns(df))).alias("numeric_column_count"),
    )


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, non_null, min, max, mean) of the numeric columns; infinities are left out."""
    chosen = list(columns or numeric_columns(df))
    measures = {"non_null": F.count, "minimum": F.min, "maximum": F.max, "mean": F.avg}
    clean = df.select(*[finite(F.col(c)).cast("double").alias(c) for c in chosen])
    row = clean.agg(*[f(F.col(c)).alias(f"{m}|{c}") for m, f in measures.items() for c in chosen])
    return _long(row, list(measures), chosen)


def detection_metrics(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """One row: records analysed, anomalies, anomaly rate in percent."""
    analysed, anomalies = F.count(F.lit(1)), F.count_if(F.col(flag))
    return df.agg(
        analysed.alias("analysed"),
        anomalies.alias("anomalies"),
        F.round(F.try_divide(anomalies * 100.0, analysed), 2).alias("anomaly_rate"),
    )
