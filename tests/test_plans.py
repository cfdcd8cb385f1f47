"""Physical plans: what reaches the scan, what is broadcast, what is shuffled."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from ledgerloom.operators import joins, quality, upsert
from ledgerloom.plans import marts, questions
from ledgerloom.queries import loading, models, standins


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def parts(spark, sf_dir):
    return {t: standins.staged(spark, sf_dir, t) for t in ("customers", "accounts", "merchants", "transactions")}


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(loading.scan_parquet(spark, sf_dir))
    assert "GreaterThan(l_discount,0.05)" in text and "GreaterThanOrEqual(l_shipdate" in text
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "l_tax" not in schema and "l_extendedprice" not in schema


def test_fact_moves_no_transaction(spark, sf_dir):
    text = plan(standins.facts(spark, sf_dir))
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert text.count("BroadcastHashJoin LeftOuter") >= 2
    assert "hashpartitioning" not in text


def test_marts_shuffle_rolled_up_rows_only(spark, sf_dir, parts):
    mart = marts.customer_summary(parts["customers"], standins.facts(spark, sf_dir))
    text = plan(mart)
    assert "partial_sum" in text
    shuffles = re.findall(r"hashpartitioning\(([^)]*)", text)
    assert all("customer_id" in keys or "c_custkey" in keys or "o_custkey" in keys for keys in shuffles)
    scan = next(s for s in re.findall(r"ReadSchema: struct<(.*)>", text) if "l_orderkey" in s)
    assert "l_comment" not in scan and "l_quantity" not in scan


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 1, id) as k")
    right = spark.range(9000).selectExpr("id as k", "id as v")
    text = plan(joins.key_join(left, right, "k", hot=[1]))
    assert "__salt" in text and "xxhash64" in text
    assert "__salt" not in plan(joins.key_join(left, right, "k"))


def test_questions_join_only_what_they_ask_for(spark, sf_dir):
    for name in ("q_total", "q_avg_by_currency", "q_last_30_days", "q_merchant_failure_rate"):
        assert "Join" not in plan(models.REGISTRY.queries[name](spark, sf_dir)), name
    assert "Join" in plan(models.REGISTRY.queries["q_top_customers"](spark, sf_dir))


def test_period_questions_read_their_days_of_a_partitioned_fact(spark, sf_dir, lake):
    facts = standins.facts(spark, sf_dir)
    lake.replace("gold", "fact_transaction", facts, ["transaction_date"])
    stored = lake.read("gold", "fact_transaction")
    assert stored.columns == facts.columns and stored.count() == facts.count()
    text = plan(questions.daily_volume(stored, models.TODAY, 30))
    assert re.search(r"PartitionFilters: \[.*transaction_date.*>=", text)


def test_orphan_count_joins_counted_keys(parts):
    text = plan(quality.orphan_count(parts["transactions"], parts["accounts"], "account_id"))
    assert "LeftAnti" in text and "partial_count" in text


def test_cutoff_is_a_scan_filter(spark, sf_dir):
    orders = standins.table(spark, sf_dir, "orders")
    text = plan(upsert.changed_rows(orders, orders.filter("o_orderdate < '1999-01-01'"), "o_orderdate"))
    assert "Subquery" in text and "NestedLoop" not in text
    assert re.search(r"(PushedFilters|DataFilters).*[Ss]ubquery|Condition.*Subquery", text)


def test_silver_is_one_narrow_stage(parts):
    text = plan(parts["transactions"])
    assert "Exchange" not in text and "Python" not in text
