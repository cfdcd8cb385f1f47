"""The shared test tables in the roles of the six raw datasets.

Text columns get blanks and mixed case, and a few rows get nulls, so that the standardisation rules
and the checks have something to find. Every dataset is a projection of the test tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import lookup, nth
from ledgerloom.operators.expand import COUNTRY_CURRENCY, CURRENCIES
from ledgerloom.operators.standardize import to_silver
from ledgerloom.plans import calendar, star
from ledgerloom.plans.staging import stage
from ledgerloom.session import pin_utc

FIRST_DAY = dt.date(1995, 1, 1)
LAST_DAY = dt.date(2001, 12, 31)
EVENT_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))

ACCOUNT_TYPES = ["checking", "savings", "investment"]
CATEGORIES = [f"category_{i}" for i in range(10)]
TYPES = ["purchase", "withdrawal", "deposit", "transfer", "payment"]
METHODS = ["card", "upi", "bank_transfer", "cash", "online"]
COUNTRIES = list(COUNTRY_CURRENCY)

FAILURE_REASONS = [f"reason_{i}" for i in range(5)]

# The schemas of the shared test tables that are used.
TEST_TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its declared schema, so no job is spent on reading footers first."""
    return pin_utc(spark).read.schema(TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def messy(column: Column) -> Column:
    """Upper case between blanks."""
    return F.concat(F.lit(" "), F.upper(column), F.lit("  "))


def messy_lower(column: Column) -> Column:
    return F.concat(F.lit("  "), F.lower(column), F.lit(" "))


def _days_after(days: Column, column: str = "1990-01-01") -> Column:
    return F.timestamp_add("DAY", days, F.lit(column).cast("timestamp"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    name = F.split("c_name", "#")
    created = _days_after(F.col("c_custkey") % 1000)
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit(" "), name[0], F.lit(" ")).alias("first_name"),
        F.concat(F.lit(" "), name[1]).alias("last_name"),
        messy(F.concat(name[0], F.lit("."), name[1], F.lit("@example.com"))).alias("email"),
        F.col("c_custkey").cast("string").alias("phone"),
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int"))
        .cast("string")
        .alias("date_of_birth"),
        messy_lower(F.col("n_name")).alias("country"),
        created.alias("created_at"),
        F.timestamp_add("DAY", F.col("c_custkey") % 37, created).cast("timestamp_ntz").alias("updated_at"),
        messy(F.when(F.col("c_acctbal") < 0, "inactive").otherwise("active")).alias("customer_status"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = {"O": "active", "P": "inactive", "F": "frozen"}
    opened = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        messy(nth(ACCOUNT_TYPES, F.col("o_orderkey") % 3)).alias("account_type"),
        messy_lower(nth(CURRENCIES, F.col("o_custkey") % 4)).alias("currency"),
        F.col("o_totalprice").alias("balance"),
        messy(lookup("o_orderstatus", status)).alias("account_status"),
        opened.alias("opened_at"),
        F.timestamp_add("DAY", F.col("o_orderkey") % 30, opened).alias("updated_at"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    s = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    country = nth(COUNTRIES, F.col("s_nationkey") % 6)
    created = _days_after(F.col("s_suppkey") % 500)
    return s.select(
        F.col("s_suppkey").alias("merchant_id"),
        F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("merchant_name"),
        messy(nth(CATEGORIES, F.col("s_suppkey") % 10)).alias("merchant_category"),
        messy_lower(country).alias("country"),
        F.col("n_name").alias("city"),
        lookup(country, COUNTRY_CURRENCY).alias("currency"),
        messy(F.when(F.col("s_acctbal") < 0, "inactive").otherwise("active")).alias("merchant_status"),
        created.alias("created_at"),
        F.timestamp_add("DAY", F.col("s_suppkey") % 45, created).cast("timestamp_ntz").alias("updated_at"),
    )


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct order days."""
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("rate_date")).distinct()


def exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate a pair for every order day, around the quotient of the places of its two currencies in the list."""
    places = list(enumerate(CURRENCIES, 1))
    pairs = [(base, target, i / j) for i, base in places for j, target in places if i != j]
    listed = [F.struct(F.lit(i).alias("i"), F.lit(b).alias("base"), F.lit(t).alias("target"), F.lit(r).alias("rate")) for i, (b, t, r) in enumerate(pairs, 1)]
    days = order_days(spark, sf_dir).select("rate_date", F.explode(F.array(*listed)).alias("p"))
    number = F.datediff("rate_date", F.lit(FIRST_DAY)) * len(pairs) + F.col("p.i")
    return days.select(
        F.format_string("fx_%08d", number).alias("exchange_rate_id"),
        messy_lower(F.col("p.base")).alias("base_currency"),
        messy_lower(F.col("p.target")).alias("target_currency"),
        (F.col("p.rate") * (F.lit(0.995) + F.lit(0.001) * (F.day("rate_date") % 11))).alias("rate"),
        F.col("rate_date").cast("string").alias("rate_date"),
        F.lit("synthetic_provider").alias("source"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per line item. Ids repeat, and untaxed undiscounted purchases lack a merchant."""
    kind = nth(TYPES, F.col("l_linenumber") % 5)
    named = (F.col("l_linenumber") % 5).isin(0, 4) & ~((F.col("l_tax") == 0) & (F.col("l_discount") == 0))
    status = (
        F.when(F.col("l_returnflag") == "A", "completed")
        .when(F.col("l_returnflag") == "N", "pending")
        .when(F.col("l_linestatus") == "F", "failed")
        .otherwise("reversed")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_orderkey").alias("account_id"),
        F.when(named, F.col("l_suppkey")).alias("merchant_id"),
        F.timestamp_add("SECOND", F.col("l_partkey") % 86400, F.col("l_shipdate").cast("timestamp")).alias(
            "transaction_timestamp"
        ),
        messy(kind).alias("transaction_type"),
        F.col("l_extendedprice").alias("amount"),
        messy_lower(nth(CURRENCIES, F.col("l_suppkey") % 6)).alias("currency"),
        messy(status).alias("transaction_status"),
        messy(nth(METHODS, F.col("l_partkey") % 5)).alias("payment_method"),
        F.concat(F.lit("part "), "l_partkey").alias("description"),
    )


def transaction_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events refer to a user's line; not all lines exist. Some failures give no reason."""
    kinds = {"error": "failed", "signup": "initiated", "view": "authorized", "purchase": "completed", "click": "reversed"}
    detail = F.get_json_object("props", "$.k").cast("int")
    failed = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws("-", "user_id", 1 + F.col("event_id") % 7).alias("transaction_id"),
        messy(lookup("event_type", kinds)).alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_timestamp"),
        messy(F.when(failed, "failure").otherwise("success")).alias("event_status"),
        F.when(failed & (detail >= 5), messy(nth(FAILURE_REASONS, detail % 5))).alias("failure_reason"),
    )


RAW = {
    "customers": customers,
    "accounts": accounts,
    "merchants": merchants,
    "exchange_rates": exchange_rates,
    "transactions": transactions,
    "transaction_events": transaction_events,
}


def raw(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return RAW[dataset](spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return to_silver(raw(spark, sf_dir, dataset), dataset)


def staged(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return stage(silver(spark, sf_dir, dataset), dataset)


def dim_date(spark: SparkSession) -> DataFrame:
    return calendar.calendar(spark, FIRST_DAY, LAST_DAY)


def event_calendar(spark: SparkSession) -> DataFrame:
    return calendar.calendar(spark, *EVENT_DAYS)


def facts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The transaction fact, or the named columns of it."""
    sides = staged(spark, sf_dir, "transactions"), staged(spark, sf_dir, "accounts"), dim_date(spark)
    return star.fact_transaction(*sides, columns or star.TRANSACTION_COLUMNS)


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_transaction_event(staged(spark, sf_dir, "transaction_events"), event_calendar(spark))
