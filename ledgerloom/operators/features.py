"""Feature preparation for anomaly detection."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import as_number, finite
from ledgerloom.functions.quantiles import approx_quantiles, exact_quantiles

MIN_ROWS = 10


class TooFewRows(ValueError):
    """The input has fewer usable rows than a check or a model needs."""


def require_rows(df: DataFrame, n: int = 1) -> None:
    """Raise unless the frame has at least ``n`` rows; stops reading once it has seen them."""
    found = df.limit(n).count()
    if found < n:
        raise TooFewRows(f"{n} rows needed, {found} found")


def with_any_feature(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows where at least one feature is neither null nor infinite."""
    return df.filter(reduce(or_, [finite(F.col(c)).isNotNull() for c in features]))


def medians(df: DataFrame, features: list[str], exact: bool = True) -> dict[str, float]:
    """Fill value of each feature: its median, or 0 where it has no value at all."""
    numbers = df.select(*[as_number(F.col(c)).alias(c) for c in features])
    find = exact_quantiles if exact else approx_quantiles
    found = find(numbers, dict.fromkeys(features, 0.5))
    return {c: 0.0 if found[c] is None else found[c] for c in features}


def usable_rows(df: DataFrame, features: list[str]) -> tuple[int, list[str]]:
    """Number of rows, and the features that some row lacks. Raises below :data:`MIN_ROWS` rows."""
    numbers = [F.count(as_number(F.col(c))).alias(f"n{i}") for i, c in enumerate(features)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *numbers).first()
    if row["rows"] < MIN_ROWS:
        raise TooFewRows(f"{MIN_ROWS} rows needed, {row['rows']} found")
    return row["rows"], [c for i, c in enumerate(features) if row[f"n{i}"] < row["rows"]]


def filled(features: list[str], fill: dict[str, float]) -> list[Column]:
    """Double features, named as their source columns; a gap takes the fill value if there is one."""
    return [
        (F.coalesce(as_number(F.col(c)), F.lit(fill[c])) if c in fill else as_number(F.col(c))).alias(c)
        for c in features
    ]


def prepare(df: DataFrame, features: list[str], keep: list[str], exact: bool = True) -> DataFrame:
    """``keep`` columns beside the cleaned, median-filled features.

    A median is only looked for where a feature has gaps.
    """
    usable = with_any_feature(df, features)
    _, gaps = usable_rows(usable, features)
    return usable.select(*keep, *filled(features, medians(usable, gaps, exact)))


def split(df: DataFrame, flag: str = "is_anomaly") -> tuple[DataFrame, DataFrame]:
    """(normal rows, flagged rows)."""
    return df.filter(~F.col(flag)), df.filter(F.col(flag))
