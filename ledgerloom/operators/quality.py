"""Quality checks and declared contracts, gathered as one result table.

A result row is (check_name, table_name, column_name, failing_rows, passed).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.joins import key_join
from ledgerloom.operators.standardize import parse_losses
from ledgerloom.schemas import MERCHANT_TYPES


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Unique:
    table: str
    column: str


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    parent: str
    parent_column: str
    null_is_orphan: bool = False
    where: str | None = None  # condition on the child rows that are tested


@dataclass(frozen=True)
class Rule:
    """A business rule: no row may meet ``failing``, an SQL condition on its columns."""

    table: str
    column: str
    name: str
    failing: str


Contract = NotNull | Unique | Relationship | Rule

# The declared tests of the star schema.
GOLD_CONTRACTS: tuple[Contract, ...] = (
    NotNull("dim_customer", "customer_id"),
    Unique("dim_customer", "customer_id"),
    NotNull("dim_account", "account_id"),
    Unique("dim_account", "account_id"),
    NotNull("dim_account", "customer_id"),
    Relationship("dim_account", "customer_id", "dim_customer", "customer_id"),
    NotNull("dim_merchant", "merchant_id"),
    Unique("dim_merchant", "merchant_id"),
    NotNull("dim_date", "date_key"),
    Unique("dim_date", "date_key"),
    NotNull("fact_transaction", "transaction_id"),
    Unique("fact_transaction", "transaction_id"),
    NotNull("fact_transaction", "account_id"),
    Relationship("fact_transaction", "account_id", "dim_account", "account_id"),
    NotNull("fact_transaction", "customer_id"),
    Relationship("fact_transaction", "customer_id", "dim_customer", "customer_id"),
    NotNull("fact_transaction", "date_key"),
    Relationship("fact_transaction", "date_key", "dim_date", "date_key"),
    NotNull("fact_transaction_event", "event_id"),
    Unique("fact_transaction_event", "event_id"),
    NotNull("fact_transaction_event", "transaction_id"),
)

NEEDS_MERCHANT = f"transaction_type IN ({', '.join(repr(t) for t in MERCHANT_TYPES)})"

# The four reference checks of the Bronze layer. A null key is an orphan in them.
BRONZE_REFERENCES: tuple[Relationship, ...] = (
    Relationship("accounts", "customer_id", "customers", "customer_id", True),
    Relationship("transactions", "account_id", "accounts", "account_id", True),
    Relationship("transactions", "merchant_id", "merchants", "merchant_id", True, NEEDS_MERCHANT),
    Relationship("transaction_events", "transaction_id", "transactions", "transaction_id", True),
)

# A merchant for purchases and payments, a reason for failed events.
BUSINESS_RULES: tuple[Rule, ...] = (
    Rule("transactions", "merchant_id", "merchant_required", f"{NEEDS_MERCHANT} AND merchant_id IS NULL"),
    Rule("transaction_events", "failure_reason", "reason_required", "event_type = 'failed' AND failure_reason IS NULL"),
)


def orphan_rows(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
    null_is_orphan: bool = True,
) -> DataFrame:
    """Child rows whose key has no parent; rows with a null key on request."""
    parents = parent.select(F.col(parent_key or key).alias(key))
    children = child if null_is_orphan else child.filter(F.col(key).isNotNull())
    return key_join(children, parents, key, "left_anti").select(*child.columns)


def orphan_count(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, null_is_orphan: bool = True
) -> DataFrame:
    """One row: orphan rows and orphan keys.

    Child rows are counted per key before the join, so the join moves keys and counts, never rows,
    and a hot or null key is a single row of it.
    """
    per_key = child.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    if not null_is_orphan:
        per_key = per_key.filter(F.col("key").isNotNull())
    parents = parent.select(F.col(parent_key or key).alias("key"))
    orphans = per_key.join(parents, "key", "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


def merchant_required(transactions: DataFrame) -> DataFrame:
    """The purchases and payments."""
    return transactions.filter(F.col("transaction_type").isin(*MERCHANT_TYPES))


def failed_without_reason(events: DataFrame) -> DataFrame:
    """Failed events that give no reason."""
    return events.filter((F.col("event_type") == "failed") & F.col("failure_reason").isNull())


def schema_check(tables: Mapping[str, DataFrame], declared: Mapping[str, str]) -> DataFrame:
    """(table_name, column_name, expected, misfits): rows with a value that the declared type cannot hold.

    A column that the table lacks has null misfits. One pass over each table.
    """
    parts = []
    for table, df in tables.items():
        fields = T.StructType.fromDDL(declared[table]).fields
        there = [f for f in fields if f.name in df.columns]
        counts = df.agg(*[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in there], F.lit(0))
        listed = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', {f'`{f.name}`' if f in there else 'CAST(NULL AS BIGINT)'}" for f in fields)
        parts.append(counts.selectExpr(f"'{table}' AS table_name", f"stack({len(fields)}, {listed}) AS (column_name, expected, misfits)"))
    return reduce(DataFrame.unionByName, parts)


def _rows(one_row: DataFrame, checks: list[tuple[str, str, str, str]]) -> DataFrame:
    """Result rows from a one-row frame; each check is (name, table, column, failing-rows column)."""
    entries = ", ".join(f"'{name}', '{table}', '{c}', bigint(coalesce(`{n}`, 0))" for name, table, c, n in checks)
    return one_row.selectExpr(
        f"stack({len(checks)}, {entries}) AS (check_name, table_name, column_name, failing_rows)"
    ).selectExpr("*", "failing_rows = 0 AS passed")


@dataclass(frozen=True)
class _Keys:
    """A column whose keys are counted, on the rows that meet ``where``."""

    table: str
    column: str
    where: str | None = None


def _families(contracts: list[Contract]) -> dict[_Keys, tuple[int, int]]:
    """Family and place in it of all columns whose keys are counted; related columns are of one family."""
    family: dict[_Keys, list[_Keys]] = {}
    for c in contracts:
        if isinstance(c, Unique):
            family.setdefault(own := _Keys(c.table, c.column), [own])
        elif isinstance(c, Relationship):
            child, parent = _Keys(c.table, c.column, c.where), _Keys(c.parent, c.parent_column)
            both = family.setdefault(parent, [parent])
            if (own := family.setdefault(child, [child])) is not both:
                both += own
                family.update(dict.fromkeys(own, both))
    numbered: dict[int, int] = {}
    for members in family.values():
        numbered.setdefault(id(members), len(numbered))
    return {keys: (numbered[id(members)], members.index(keys)) for keys, members in family.items()}


def _key_type(tables: Mapping[str, DataFrame], members: list[_Keys]) -> T.DataType:
    """The type in which the keys of a family are compared."""
    empty = [tables[m.table].select(F.col(m.column).alias("key")).limit(0) for m in members]
    return reduce(DataFrame.union, empty).schema["key"].dataType


def _key_columns(column: str, kind: T.DataType) -> tuple[Column, Column]:
    """The key as a long or as a text; the other one is null."""
    key = F.col(column).cast(kind)
    if isinstance(kind, T.IntegralType):
        return key.cast("long"), F.lit(None).cast("string")
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        key += F.lit(0.0)  # one zero
    return F.lit(None).cast("long"), F.hex(key) if isinstance(kind, T.BinaryType) else key.cast("string")


def run_contracts(tables: Mapping[str, DataFrame], contracts: Iterable[Contract]) -> DataFrame:
    """Result table of the contracts, in one scan of each table and one shuffle for all of them.

    A row of a table becomes one small row for each tested column: the family of columns it is compared with, the key,
    and which column of the family it is. One grouping counts every key of a family in all its columns at once, so a
    unique test is a count above one, a relationship a key with children and no parent, and nothing is joined. The map
    side combines a hot or null key. Columns tested for nulls only, and rules, send their failing rows as one count.
    """
    contracts = list(contracts)
    places = _families(contracts)
    members: dict[int, list[_Keys]] = {}
    for keys, (family, _) in places.items():
        members.setdefault(family, []).append(keys)
    kinds = {family: _key_type(tables, own) for family, own in members.items()}

    sent: dict[str, list[Column]] = {c.table: [] for c in contracts} | {keys.table: [] for keys in places}

    def send(table: str, family: int, place: int, long: Column, text: Column, where: str | None) -> None:
        row = F.struct(F.lit(family).alias("family"), F.lit(place).alias("place"), long.alias("long"), text.alias("text"))
        sent[table].append(F.when(F.expr(where), row) if where else row)

    for keys, (family, place) in places.items():
        send(keys.table, family, place, *_key_columns(keys.column, kinds[family]), keys.where)

    no_key = F.col("long").isNull() & F.col("text").isNull()
    found: list[Column] = []
    for c in contracts:
        if isinstance(c, Relationship):
            (family, child), (_, parent) = places[_Keys(c.table, c.column, c.where)], places[_Keys(c.parent, c.parent_column)]
            orphan = F.when(no_key, F.lit(c.null_is_orphan)).otherwise(F.col(f"n{parent}") == 0)
            failing = F.sum(F.when((F.col("family") == family) & orphan, F.col(f"n{child}")))
        elif isinstance(c, Unique):
            family, place = places[_Keys(c.table, c.column)]
            failing = F.count_if((F.col("family") == family) & ~no_key & (F.col(f"n{place}") > 1))
        else:
            family, place = places.get(_Keys(c.table, c.column), (None, 0)) if isinstance(c, NotNull) else (None, 0)
            if family is None:
                family = len(members)
                members[family] = []
                where = f"`{c.column}` IS NULL" if isinstance(c, NotNull) else c.failing
                send(c.table, family, 0, F.lit(None).cast("long"), F.lit(None).cast("string"), where)
            failing = F.sum(F.when((F.col("family") == family) & no_key, F.col(f"n{place}")))
        found.append(failing.alias(f"c{len(found)}"))

    rows = [tables[t].select(F.inline(F.array(*structs))).filter("family IS NOT NULL") for t, structs in sent.items()]
    widest = max(1, *(len(own) for own in members.values()))
    counted = reduce(DataFrame.unionAll, rows).groupBy("family", "long", "text")
    counted = counted.agg(*[F.count_if(F.col("place") == i).alias(f"n{i}") for i in range(widest)])
    names = {NotNull: "not_null", Unique: "unique", Relationship: "relationship"}
    checks = [(c.name if isinstance(c, Rule) else names[type(c)], c.table, c.column, f"c{i}") for i, c in enumerate(contracts)]
    return _rows(counted.agg(*found), checks)


def parse_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values of raw datasets that their Silver form loses, per typed column."""
    parts = []
    for table, df in tables.items():
        if lost := parse_losses(table):
            counted = df.agg(*[F.count_if(is_lost).alias(c) for c, is_lost in lost.items()])
            parts.append(_rows(counted, [("parse_loss", table, c, c) for c in lost]))
    return reduce(DataFrame.unionByName, parts)


def null_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null counts of all columns, for information: they always pass."""
    parts = []
    for table, df in tables.items():
        counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
        parts.append(_rows(counted, [("null_count", table, c, c) for c in df.columns]).withColumn("passed", F.lit(True)))
    return reduce(DataFrame.unionByName, parts)


def bronze_report(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """Key, reference and business-rule results of the six Bronze or Silver datasets.

    The merchant reference covers purchases and payments only.
    """
    checks: list[Contract] = []
    for table, key in keys.items():
        checks += [NotNull(table, key), Unique(table, key)]
    return run_contracts(tables, [*checks, *BRONZE_REFERENCES, *BUSINESS_RULES])
