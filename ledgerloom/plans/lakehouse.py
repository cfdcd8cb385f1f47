"""The runs of the lakehouse: batch load to marts, stream load to Bronze, detection to incidents."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ledgerloom.functions.numeric import recommended_features
from ledgerloom.operators import incidents, isolation_forest
from ledgerloom.operators.quality import GOLD_CONTRACTS, bronze_report, null_report, parse_report, run_contracts
from ledgerloom.operators.standardize import SILVER_RULES, to_silver
from ledgerloom.operators.upsert import changed_rows
from ledgerloom.plans import calendar, marts, star
from ledgerloom.plans.staging import stage
from ledgerloom.schemas import PRIMARY_KEYS, RAW, STREAM_TRANSACTION
from ledgerloom.sources.files import require_landed, scan_parquet, stamp
from ledgerloom.sources.lake import Lake, load_tables
from ledgerloom.streaming import bronze
from ledgerloom.streaming.landing import read_landing

# The incrementally merged dimensions and their datasets.
DIMENSIONS = {"dim_customer": "customers", "dim_account": "accounts", "dim_merchant": "merchants"}


def load_bronze(lake: Lake, raw: str, only: str | None = None) -> DataFrame:
    """Stamped full refresh of the six datasets (or one) from ``<raw>/<dataset>/``.

    A file without a declared column fails its table. Transactions that came in by stream stay: the refresh replaces
    the rows that were read below ``raw``.
    """
    spark = lake.spark
    readers = {t: lambda t=t: stamp(scan_parquet(spark, f"{raw}/{t}", RAW[t])) for t in RAW}
    batch, key = readers["transactions"], PRIMARY_KEYS["transactions"]
    readers["transactions"] = lambda: bronze.with_streamed(lake, "transactions", batch(), f"{raw}/transactions", key)
    return load_tables(lake, "bronze", readers, only, declared=RAW)


def check_bronze(lake: Lake) -> DataFrame:
    """Key, reference, rule and parse results, and the null counts of all columns."""
    tables = {t: lake.read("bronze", t) for t in RAW}
    return bronze_report(tables, PRIMARY_KEYS).unionByName(parse_report(tables)).unionByName(null_report(tables))


def build_silver(lake: Lake) -> None:
    for dataset in SILVER_RULES:
        lake.replace("silver", dataset, to_silver(lake.read("bronze", dataset), dataset))


def staged(lake: Lake) -> dict[str, DataFrame]:
    """The staging views, registered as ``stg_<dataset>``."""
    return {t: lake.view(f"stg_{t}", stage(lake.read("silver", t), t)) for t in RAW}


def merge_dimension(lake: Lake, dimension: str, source: DataFrame, key: str) -> None:
    """Load an incremental dimension: all of the source the first time, then its changed rows into the files that hold their keys."""
    if lake.exists("gold", dimension):
        lake.merge("gold", dimension, changed_rows(source, lake.read("gold", dimension)), key, ["updated_at"])
    else:
        lake.replace("gold", dimension, source)


def build_gold(lake: Lake, first: dt.date = calendar.FIRST_DAY, last: dt.date = calendar.LAST_DAY) -> None:
    """Merge the dimensions, rebuild calendar and facts."""
    views = staged(lake)
    for dimension, dataset in DIMENSIONS.items():
        merge_dimension(lake, dimension, views[dataset], PRIMARY_KEYS[dataset])
    days = calendar.calendar(lake.spark, first, last)
    lake.replace("gold", "dim_date", days)
    facts = star.fact_transaction(views["transactions"], lake.read("gold", "dim_account"), days)
    lake.replace("gold", "fact_transaction", facts, ["transaction_date"])
    events = star.fact_transaction_event(views["transaction_events"], days)
    lake.replace("gold", "fact_transaction_event", events, ["event_date"])
    lake.replace("gold", "fact_exchange_rate", star.fact_exchange_rate(views["exchange_rates"]))


def check_gold(lake: Lake) -> DataFrame:
    tables = {c.table for c in GOLD_CONTRACTS}
    return run_contracts({t: lake.read("gold", t) for t in tables}, GOLD_CONTRACTS)


def build_marts(lake: Lake) -> None:
    facts = lake.read("gold", "fact_transaction")
    built = {
        "customer_transaction_summary": marts.customer_summary(lake.read("gold", "dim_customer"), facts),
        "merchant_performance": marts.merchant_performance(lake.read("gold", "dim_merchant"), facts),
        "daily_transaction_metrics": marts.daily_metrics(lake.read("gold", "dim_date"), facts),
        "transaction_failure_analysis": marts.failure_analysis(lake.read("gold", "fact_transaction_event")),
    }
    for table, df in built.items():
        lake.replace("marts", table, df)


def run(lake: Lake, raw: str, first: dt.date = calendar.FIRST_DAY, last: dt.date = calendar.LAST_DAY) -> DataFrame:
    """The whole batch run; returns the Bronze and Gold check results."""
    load_bronze(lake, raw)
    checks = check_bronze(lake)
    build_silver(lake)
    build_gold(lake, first, last)
    build_marts(lake)
    return checks.unionByName(check_gold(lake))


def run_stream(lake: Lake, landed: str, state: str, max_files: int | None = None, archive: str | None = None) -> DataFrame:
    """Load newly landed transactions into Bronze, then check it; for a scheduler to repeat.

    ``state`` keeps the progress and the rejected records. Without ``archive`` it fails if nothing has landed at all;
    with it, loaded files are moved there, so that the landing folder stays small.
    """
    if archive is None:
        require_landed(lake.spark, landed)
    records = read_landing(lake.spark, landed, STREAM_TRANSACTION, max_files, keep_corrupt=True, archive=archive)
    loading = bronze.load_stream(
        lake,
        bronze.typed_transactions(records),
        "transactions",
        PRIMARY_KEYS["transactions"],
        f"{state}/progress",
        f"{state}/rejects",
        ["transaction_timestamp"],
    )
    loading.awaitTermination()
    return check_bronze(lake)


def run_detection(
    lake: Lake, features: list[str] | None = None, contamination: float = isolation_forest.CONTAMINATION
) -> DataFrame:
    """Fit a forest on the transaction fact, score it, and store the forest, ``ai.scored_transactions`` and ``ai.incidents``.

    Features default to the fact's first numeric columns that are no ids.
    """
    facts = lake.read("gold", "fact_transaction")
    chosen = features or recommended_features(facts)
    forest = isolation_forest.fit_stored(lake, facts, chosen, identity=["transaction_id"])
    detected = isolation_forest.detect(facts, chosen, contamination, forest=forest)
    lake.replace("ai", "scored_transactions", detected)
    scored = lake.read("ai", "scored_transactions")
    base = incidents.baseline(scored, chosen)
    lake.replace("ai", "incidents", incidents.incident_table(scored.filter("is_anomaly"), "transaction_id", base))
    return lake.read("ai", "incidents")
