from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.upsert import changed_rows, changed_rows_sql, merge_increment, one_per_key, upsert
from tests.conftest import utc, values

SCHEMA = "k string, v string, updated_at timestamp"


@pytest.fixture(scope="module")
def frames(spark):
    target = spark.createDataFrame(
        [("a", "old", utc("2024-01-10 12:00:00")), ("b", "old", utc("2024-01-01 00:00:00")), (None, "old", None)], SCHEMA
    )
    source = spark.createDataFrame(
        [
            ("a", "new", utc("2024-01-11 00:00:00")),
            ("b", "edge", utc("2024-01-09 12:00:00")),
            ("c", "late", utc("2024-01-09 11:59:59")),
            ("d", "insert", utc("2024-02-01 00:00:00")),
            ("e", "undated", None),
            (None, "unkeyed", utc("2024-02-01 00:00:00")),
        ],
        SCHEMA,
    )
    return target, source


def test_cutoff_is_inclusive_and_skips_null_times(frames):
    target, source = frames
    for select in (changed_rows, changed_rows_sql):
        assert values(select(source, target), "v") == [("edge",), ("insert",), ("new",), ("unkeyed",)]


def test_empty_target_takes_every_dated_row(frames):
    target, source = frames
    assert changed_rows(source, target.limit(0)).count() == 5
    assert changed_rows_sql(source, target.limit(0)).count() == 5


def test_merge(frames):
    target, source = frames
    merged = merge_increment(target, source, "k")
    assert values(merged, "k", "v") == [
        (None, "old"), (None, "unkeyed"), ("a", "new"), ("b", "edge"), ("d", "insert")
    ]


def test_first_run_takes_all(frames):
    assert merge_increment(None, frames[1], "k").count() == 6


def test_replay_changes_nothing_but_null_keys(frames):
    target, source = frames
    keyed = source.filter("k is not null")
    once = merge_increment(target, keyed, "k")
    assert values(merge_increment(once, keyed, "k")) == values(once)


def test_repeated_source_key_fails_or_keeps_the_latest(spark):
    rows = [("a", "1", utc("2024-01-01 00:00:00")), ("a", "2", utc("2024-01-03 00:00:00")), ("a", "9", utc("2024-01-02 00:00:00"))]
    changes = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception, match="more than one source row for k = a"):
        upsert(changes.limit(0), changes, "k").collect()
    assert values(one_per_key(changes, "k", ["updated_at"], "latest"), "v") == [("2",)]
    with pytest.raises(ValueError):
        one_per_key(changes, "k", on_duplicate="first")


def test_latest_breaks_ties_by_the_other_columns(spark):
    changes = spark.range(100).select(F.lit("a").alias("k"), F.lpad(F.col("id").cast("string"), 3, "0").alias("v"), F.lit(utc("2024-01-01 00:00:00")).alias("updated_at"))
    for parts in (1, 7):
        assert values(one_per_key(changes.repartition(parts), "k", ["updated_at"], "latest"), "v") == [("099",)]
