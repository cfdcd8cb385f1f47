"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default range of the calendar.
FIRST_DAY = dt.date(2021, 1, 1)
LAST_DAY = dt.date(2026, 12, 31)

# A broadcast calendar may span this many days (about 270 years).
MAX_DAYS = 100_000


def calendar(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    """One row per day from ``first`` to ``last``; the size is fixed by the two dates."""
    days = (last - first).days + 1
    if not 0 < days <= MAX_DAYS:
        raise ValueError(f"a calendar holds 1 to {MAX_DAYS} days, not {days}")
    bounds = spark.range(1).select(F.lit(first).alias("first_value"), F.lit(last).alias("last_value"))
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Calendar over a one-row (first_value, last_value) frame, such as the range of a date column."""
    every_day = F.expr("sequence(to_date(first_value), to_date(last_value), interval 1 day)")
    return bounds.select(F.explode(every_day).alias("full_date")).select(
        F.date_format("full_date", "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.weekofyear("full_date").alias("week_of_year"),
        F.day("full_date").alias("day"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.dayofweek("full_date").isin(1, 7).alias("is_weekend"),
    )
