"""Numeric cleaning expressions and the choice of feature columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(column: Column) -> Column:
    """Infinity and NaN become null; other values, also text that is no number, stay as they are."""
    value = column.try_cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(column)


def as_number(column: Column) -> Column:
    """Double, or null where the value does not parse, is infinite or is NaN."""
    return finite(column.try_cast("double"))


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type; decimals count."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def looks_like_id(name: str, legacy_substring: bool = False) -> bool:
    """Whether a column name has the word ``id`` or ``key``.

    Words are separated by ``_``. ``legacy_substring`` matches anywhere, so it also drops names such
    as ``paid_amount``.
    """
    lowered = name.lower()
    parts = lowered if legacy_substring else lowered.split("_")
    return any(word in parts for word in ("id", "key"))


def recommended_features(df: DataFrame, limit: int = 3, legacy_substring: bool = False) -> list[str]:
    """Default features: the first numeric columns that are no ids, or any numeric ones if all are."""
    numeric = numeric_columns(df)
    plain = [c for c in numeric if not looks_like_id(c, legacy_substring)]
    return (plain or numeric)[:limit]
