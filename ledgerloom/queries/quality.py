"""Quality checks, contracts, profiles and the SQL audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import profile, quality
from ledgerloom.operators.sql_audit import FORBIDDEN, audit
from ledgerloom.operators.standardize import merchant_id_valid
from ledgerloom.plans.staging import COLUMNS
from ledgerloom.queries import Registry, standins
from ledgerloom.queries.loading import new_lake
from ledgerloom.queries.standins import dim_date, event_facts, facts, raw, silver, staged, table
from ledgerloom.schemas import PRIMARY_KEYS
from ledgerloom.schemas import RAW as DECLARED
from ledgerloom.session import scratch_dir
from ledgerloom.sources import files

REGISTRY = Registry({}, {})
query = REGISTRY.add


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _pk_sql(dataset: str, key: str) -> str:
    return f"""
        SELECT '{dataset}' AS table_name, count(*) AS total_rows,
               count(DISTINCT {key}) + CAST(count(*) > count({key}) AS INTEGER) AS distinct_keys,
               count(*) - count(DISTINCT {key}) - CAST(count(*) > count({key}) AS INTEGER) AS duplicate_rows,
               count(*) - count({key}) AS null_keys,
               (SELECT count(*) FROM (SELECT {key} FROM silver_{dataset} WHERE {key} IS NOT NULL
                                      GROUP BY {key} HAVING count(*) > 1)) AS repeated_keys
        FROM silver_{dataset}"""


@query("dq_pk_report", " UNION ALL ".join(_pk_sql(d, k) for d, k in PRIMARY_KEYS.items()))
def dq_pk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union([profile.key_report(raw(spark, sf_dir, d), k, d) for d, k in PRIMARY_KEYS.items()])


def _names(dataset: str) -> list[str]:
    """Silver columns of a dataset that staging also has, derived ones left out."""
    return [c if isinstance(c, str) else c[0] for c in COLUMNS[dataset] if isinstance(c, str) or c[1] == "timestamp"]


@query(
    "dq_null_counts",
    " UNION ALL ".join(
        f"SELECT '{d}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM silver_{d}"
        for d in PRIMARY_KEYS
        for c in _names(d)
    ),
)
def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [profile.null_counts(silver(spark, sf_dir, d).select(*_names(d))).withColumn("table_name", F.lit(d)) for d in PRIMARY_KEYS]
    return _union(parts)


@query(
    "dq_null_by_group",
    """
    SELECT 'transactions' AS table_name, transaction_type AS group_value,
           count(*) FILTER (merchant_id IS NULL) AS null_rows FROM raw_transactions GROUP BY transaction_type
    UNION ALL
    SELECT 'transaction_events', event_type, count(*) FILTER (failure_reason IS NULL)
    FROM raw_transaction_events GROUP BY event_type
    """,
)
def dq_null_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(dataset: str, group: str, column: str) -> DataFrame:
        counted = profile.null_counts_by(raw(spark, sf_dir, dataset), group, column)
        return counted.select(F.lit(dataset).alias("table_name"), F.col(group).alias("group_value"), "null_rows")

    return part("transactions", "transaction_type", "merchant_id").unionByName(
        part("transaction_events", "event_type", "failure_reason")
    )


@query(
    "file_drift",
    """
    SELECT 1 AS files, count(*) AS rows, '' AS missing, '' AS added, '' AS retyped FROM events WHERE event_id % 3 = 0
    UNION ALL SELECT 1, count(*), 'value', 'amount', '' FROM events WHERE event_id % 3 = 1
    UNION ALL SELECT 1, count(*), '', 'kind', 'user_id bigint -> string' FROM events WHERE event_id % 3 = 2
    """,
)
def file_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in three files of one folder: as declared, with a renamed column, and with one retyped and one added."""
    path = scratch_dir(spark, "drift")
    events = table(spark, sf_dir, "events")
    changed = [events, events.withColumnRenamed("value", "amount"), events.withColumns({"user_id": F.col("user_id").cast("string"), "kind": F.lit(1)})]
    for i, part in enumerate(changed):
        part.filter(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(path)
    kinds = files.file_drift(spark, path, standins.TEST_TABLES["events"])
    rows = spark.read.schema("event_id bigint").parquet(path).groupBy(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name")).agg(F.count(F.lit(1)).alias("rows"))
    found = kinds.withColumn("name", F.element_at(F.split("first_file", "/"), -1)).join(rows, "name")
    return found.select(F.col("files").cast("int").alias("files"), "rows", *[F.array_join(c, ",").alias(c) for c in ("missing", "added", "retyped")])


@query("value_counts", "SELECT transaction_status, count(*) AS rows FROM silver_transactions GROUP BY ALL")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(silver(spark, sf_dir, "transactions"), "transaction_status")


@query(
    "merchant_valid_flag",
    """
    SELECT merchant_id_valid, count(*) AS rows
    FROM (SELECT NOT (transaction_type IN ('payment', 'purchase') AND merchant_id IS NULL) AS merchant_id_valid
          FROM silver_transactions)
    GROUP BY merchant_id_valid
    """,
)
def merchant_valid_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = silver(spark, sf_dir, "transactions").withColumn("merchant_id_valid", merchant_id_valid())
    return profile.value_counts(flagged, "merchant_id_valid")


def _orphan_sql(child: str, parent: str, key: str, parent_key: str | None = None, where: str = "TRUE") -> str:
    return f"""
        SELECT count(*) AS orphan_rows,
               count(DISTINCT c.{key}) + CAST(count(*) > count(c.{key}) AS INTEGER) AS orphan_keys
        FROM {child} c WHERE {where}
          AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key or key} = c.{key})"""


def _orphans(child: str, parent: str, key: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.orphan_count(silver(spark, sf_dir, child), silver(spark, sf_dir, parent), key)

    name = "events" if child == "transaction_events" else child
    REGISTRY.put(f"dq_orphan_{name}", run, _orphan_sql(f"silver_{child}", f"silver_{parent}", key))


_orphans("accounts", "customers", "customer_id")
_orphans("transactions", "accounts", "account_id")
_orphans("transaction_events", "transactions", "transaction_id")


@query(
    "dq_orphan_required",
    _orphan_sql(
        "silver_transactions", "silver_merchants", "merchant_id", where="c.transaction_type IN ('payment', 'purchase')"
    ),
)
def dq_orphan_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    required = quality.merchant_required(silver(spark, sf_dir, "transactions"))
    return quality.orphan_count(required, silver(spark, sf_dir, "merchants"), "merchant_id")


@query(
    "dq_orphan_nullable",
    f"""
    SELECT 'transactions' AS child, * FROM
        ({_orphan_sql("silver_transactions", "silver_merchants", "merchant_id", where="c.merchant_id IS NOT NULL")})
    UNION ALL SELECT 'documents', * FROM ({_orphan_sql("documents", "labels", "doc_id", where="c.doc_id IS NOT NULL")})
    """,
)
def dq_orphan_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys are no violation here."""
    merchants = quality.orphan_count(
        silver(spark, sf_dir, "transactions"), silver(spark, sf_dir, "merchants"), "merchant_id", null_is_orphan=False
    )
    labels = quality.orphan_count(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id", null_is_orphan=False
    )
    return merchants.withColumn("child", F.lit("transactions")).unionByName(labels.withColumn("child", F.lit("documents")))


@query(
    "dq_orphan_event_rows",
    "SELECT c.* FROM silver_transaction_events c WHERE NOT EXISTS "
    "(SELECT 1 FROM silver_transactions p WHERE p.transaction_id = c.transaction_id)",
)
def dq_orphan_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, transactions = silver(spark, sf_dir, "transaction_events"), silver(spark, sf_dir, "transactions")
    return quality.orphan_rows(events, transactions, "transaction_id")


@query(
    "dq_failed_without_reason",
    "SELECT * FROM silver_transaction_events WHERE event_type = 'failed' AND failure_reason IS NULL",
)
def dq_failed_without_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failed_without_reason(silver(spark, sf_dir, "transaction_events"))


# Types that the columns are checked against; some are too narrow for the values, and two columns are not there.
CHECKED = {
    "orders": "o_orderkey bigint, o_orderstatus string, o_totalprice decimal(7,2), o_orderdate timestamp_ntz, o_clerk string",
    "events": "event_id bigint, event_type string, value double, props int",
    "customer": "c_custkey int, c_name bigint, c_acctbal decimal(5,2), c_phone string",
}


def _misfits_sql(name: str, column: str, kind: str) -> str:
    row = f"SELECT '{name}' AS table_name, '{column}' AS column_name, '{kind}' AS expected, "
    if column in ("o_clerk", "c_phone"):
        return row + "CAST(NULL AS BIGINT) AS misfits"
    duck = kind.replace("timestamp_ntz", "timestamp").replace("string", "varchar")
    return row + f"count(*) FILTER ({column} IS NOT NULL AND TRY_CAST({column} AS {duck}) IS NULL) AS misfits FROM {name}"


@query("schema_check", " UNION ALL ".join(_misfits_sql(t, *c.split(" ", 1)) for t, ddl in CHECKED.items() for c in ddl.split(", ")))
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files' own columns against declared ones."""
    return quality.schema_check({t: files.scan_parquet(spark, f"{sf_dir}/{t}.parquet") for t in CHECKED}, CHECKED)


def spoiled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw datasets with values in them that no typed column can hold."""
    tables = {d: raw(spark, sf_dir, d) for d in DECLARED}
    line = F.split("transaction_id", "-")[1].cast("int")
    amount = F.when(line == 7, 1e17).otherwise(F.col("amount"))
    tables["transactions"] = tables["transactions"].withColumn("amount", amount)
    born = F.when(F.col("customer_id") % 10 == 0, "31.12.1999").when(F.col("customer_id") % 10 == 1, " ").otherwise(F.col("date_of_birth"))
    tables["customers"] = tables["customers"].withColumn("date_of_birth", born)
    return tables


@query(
    "parse_losses",
    """
    SELECT 'parse_loss' AS check_name, *, failing_rows = 0 AS passed FROM (
        SELECT 'customers' AS table_name, 'date_of_birth' AS column_name, count(*) FILTER (c_custkey % 10 = 0) AS failing_rows FROM customer
        UNION ALL SELECT 'exchange_rates', 'rate_date', 0
        UNION ALL SELECT 'transactions', 'transaction_timestamp', 0
        UNION ALL SELECT 'transactions', 'amount', count(*) FILTER (l_linenumber = 7) FROM lineitem
        UNION ALL SELECT 'transaction_events', 'event_timestamp', 0)
    """,
)
def parse_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.parse_report(spoiled(spark, sf_dir))


def _results_sql(checks: list[tuple[str, str, str, str]]) -> str:
    """Union of (check, table, column, SQL that counts the failing rows)."""
    parts = [
        f"SELECT '{check}' AS check_name, '{name}' AS table_name, '{column}' AS column_name, ({count}) AS failing_rows"
        for check, name, column, count in checks
    ]
    return f"SELECT *, failing_rows = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


def _null_sql(source: str, column: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} IS NULL"


def _repeat_sql(source: str, column: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def _missing_sql(source: str, column: str, parent: str, parent_column: str, nulls: bool = False) -> str:
    return (
        f"SELECT count(*) FROM {source} c WHERE {'TRUE' if nulls else f'c.{column} IS NOT NULL'} AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})"
    )


GOLD_SOURCES = {
    "dim_customer": "silver_customers",
    "dim_account": "silver_accounts",
    "dim_merchant": "silver_merchants",
    "dim_date": "days",
    "fact_transaction": "facts",
    "fact_transaction_event": "event_facts",
}
GOLD_KEYS = {
    "dim_customer": "customer_id", "dim_account": "account_id", "dim_merchant": "merchant_id",
    "dim_date": "date_key", "fact_transaction": "transaction_id", "fact_transaction_event": "event_id",
}
GOLD_REQUIRED = [
    ("dim_account", "customer_id"), ("fact_transaction", "account_id"), ("fact_transaction", "customer_id"),
    ("fact_transaction", "date_key"), ("fact_transaction_event", "transaction_id"),
]
GOLD_PARENTS = [
    ("dim_account", "customer_id", "dim_customer"), ("fact_transaction", "account_id", "dim_account"),
    ("fact_transaction", "customer_id", "dim_customer"), ("fact_transaction", "date_key", "dim_date"),
]


@query(
    "contract_results",
    _results_sql(
        [("unique", t, k, _repeat_sql(GOLD_SOURCES[t], k)) for t, k in GOLD_KEYS.items()]
        + [("not_null", t, c, _null_sql(GOLD_SOURCES[t], c)) for t, c in [*GOLD_KEYS.items(), *GOLD_REQUIRED]]
        + [
            ("relationship", t, c, _missing_sql(GOLD_SOURCES[t], c, GOLD_SOURCES[p], c))
            for t, c, p in GOLD_PARENTS
        ]
    ),
)
def contract_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction fact is written first, as eight checks read columns of it."""
    lake = new_lake(spark, "contracts")
    tables = {
        "dim_customer": staged(spark, sf_dir, "customers"),
        "dim_account": staged(spark, sf_dir, "accounts"),
        "dim_merchant": staged(spark, sf_dir, "merchants"),
        "dim_date": dim_date(spark),
        "fact_transaction_event": event_facts(spark, sf_dir),
    }
    lake.replace("gold", "fact_transaction", facts(spark, sf_dir))
    return quality.run_contracts({**tables, "fact_transaction": lake.read("gold", "fact_transaction")}, quality.GOLD_CONTRACTS)


@query(
    "quality_report",
    _results_sql(
        [("unique", d, k, _repeat_sql(f"silver_{d}", k)) for d, k in PRIMARY_KEYS.items()]
        + [("not_null", d, k, _null_sql(f"silver_{d}", k)) for d, k in PRIMARY_KEYS.items()]
        + [
            ("relationship", "accounts", "customer_id", _missing_sql("silver_accounts", "customer_id", "silver_customers", "customer_id", True)),
            ("relationship", "transactions", "account_id", _missing_sql("silver_transactions", "account_id", "silver_accounts", "account_id", True)),
            ("relationship", "transaction_events", "transaction_id", _missing_sql("silver_transaction_events", "transaction_id", "silver_transactions", "transaction_id", True)),
            ("relationship", "transactions", "merchant_id", _missing_sql("(SELECT * FROM silver_transactions WHERE transaction_type IN ('payment', 'purchase'))", "merchant_id", "silver_merchants", "merchant_id", True)),
            ("merchant_required", "transactions", "merchant_id", "SELECT count(*) FROM silver_transactions WHERE transaction_type IN ('payment', 'purchase') AND merchant_id IS NULL"),
            ("reason_required", "transaction_events", "failure_reason", "SELECT count(*) FROM silver_transaction_events WHERE event_type = 'failed' AND failure_reason IS NULL"),
        ]
    ),
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.bronze_report({d: silver(spark, sf_dir, d) for d in PRIMARY_KEYS}, PRIMARY_KEYS)


MEASURED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "numeric_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null, min({c}) AS minimum, max({c}) AS maximum, "
        f"round(avg({c}), 4) AS mean FROM lineitem"
        for c in MEASURED
    ),
)
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiled = profile.numeric_profile(table(spark, sf_dir, "lineitem"), MEASURED)
    return profiled.withColumn("mean", F.round("mean", 4))


@query(
    "dataset_shape",
    """SELECT (SELECT count(*) FROM lineitem) AS row_count, count(*) AS column_count,
              count(*) FILTER (column_type IN ('BIGINT', 'INTEGER', 'DOUBLE')) AS numeric_column_count
       FROM (DESCRIBE lineitem)""",
)
def dataset_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.shape(table(spark, sf_dir, "lineitem"))


#: Statements around the text of every document, by doc_id % 10.
TEXTS = """
    SELECT doc_id AS query_id, lang, source, CASE doc_id % 10
        WHEN 0 THEN 'SELECT * FROM gold.fact_transaction WHERE description = ''' || text || ''';'
        WHEN 1 THEN 'Here you are:' || chr(10) || '```sql' || chr(10) || 'with t as (select * from Marts.daily) '
                    || 'select * from t -- ' || text || chr(10) || ';' || chr(10) || '```'
        WHEN 2 THEN text
        WHEN 3 THEN 'drop table gold.' || lang || ' -- ' || text
        WHEN 4 THEN 'select ' || n_chars || ' from bronze.' || lang || ' join lake.silver.' || source || ' on true'
        WHEN 5 THEN '  select replace(x, ''' || lang || ''') from gold.t; /* ' || text || ' */'
        WHEN 6 THEN 'select updated_at, ''' || text || ''' from plain join ' || lang || '.gold.t using (k)'
        WHEN 7 THEN 'select * from gold.a x, `silver`.`' || lang || '` y,lake.raw.' || source || ' join' || chr(160) || 'marts.m'
        WHEN 8 THEN 'select * from (gold.t join raw.' || source || ') s, silver.t where x = ''' || text || ''''
        ELSE '```' || chr(10) || 'select 1 from silver.' || lang || chr(10) || '```' || text END AS sql_text
    FROM documents
"""
WRITES = ", ".join(f"'{word}'" for word in FORBIDDEN)


@query(
    "sql_audit",
    # A fence is what stands between the first two; which schemas a statement names follows from its shape.
    rf"""
    SELECT query_id, starts AS is_query, words AS forbidden_words, names AS foreign_schemas, starts AND words = '' AND names = '' AS accepted
    FROM (SELECT query_id, low LIKE 'select%' OR low LIKE 'with%' AS starts,
                 array_to_string(list_sort(list_distinct(list_intersect(regexp_split_to_array(low, '[^a-z0-9_]+'), [{WRITES}]))), ',') AS words,
                 CASE query_id % 10 WHEN 4 THEN 'bronze,silver' WHEN 7 THEN 'raw,silver' WHEN 8 THEN 'raw' WHEN 9 THEN 'silver' ELSE '' END AS names
          FROM (SELECT query_id, lower(trim(CASE WHEN len(parts) > 2 THEN parts[2][CASE WHEN parts[2] LIKE 'sql%' THEN 4 ELSE 1 END :] ELSE sql_text END, chars)) AS low
                FROM (SELECT query_id, sql_text, string_split(sql_text, '```') AS parts, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS chars FROM ({TEXTS}))))
    """,
)
def sql_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, lang, source = F.col("text"), F.col("lang"), F.col("source")
    shapes = [
        F.concat(F.lit("SELECT * FROM gold.fact_transaction WHERE description = '"), text, F.lit("';")),
        F.concat(
            F.lit("Here you are:\n```sql\nwith t as (select * from Marts.daily) select * from t -- "), text, F.lit("\n;\n```")
        ),
        text,
        F.concat(F.lit("drop table gold."), lang, F.lit(" -- "), text),
        F.concat(F.lit("select "), "n_chars", F.lit(" from bronze."), lang, F.lit(" join lake.silver."), source, F.lit(" on true")),
        F.concat(F.lit("  select replace(x, '"), lang, F.lit("') from gold.t; /* "), text, F.lit(" */")),
        F.concat(F.lit("select updated_at, '"), text, F.lit("' from plain join "), lang, F.lit(".gold.t using (k)")),
        F.concat(F.lit("select * from gold.a x, `silver`.`"), lang, F.lit("` y,lake.raw."), source, F.lit(" join\u00a0marts.m")),
        F.concat(F.lit("select * from (gold.t join raw."), source, F.lit(") s, silver.t where x = '"), text, F.lit("'")),
        F.concat(F.lit("```\nselect 1 from silver."), lang, F.lit("\n```"), text),
    ]
    return _audited(spark, sf_dir, shapes, strict=False)


def _audited(spark: SparkSession, sf_dir: str, shapes: list[Column], strict: bool) -> DataFrame:
    """The audit of a statement for each document, its shape taken by doc_id."""
    shape = F.coalesce(*[F.when(F.col("doc_id") % len(shapes) == i, s) for i, s in enumerate(shapes)])
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("query_id"), shape.alias("sql_text"))
    found = ["forbidden_words", "foreign_schemas", *(["unqualified"] if strict else [])]
    return audit(texts, strict=strict).select("query_id", "is_query", *[F.array_join(c, ",").alias(c) for c in found], "accepted")


@query(
    "sql_audit_strict",
    # What the text holds never matters, as it stands in literals and comments alone.
    """
    SELECT query_id, is_query, forbidden_words, foreign_schemas, unqualified, is_query AND forbidden_words = '' AND foreign_schemas = '' AND unqualified = '' AS accepted
    FROM (SELECT doc_id AS query_id, doc_id % 8 NOT IN (3, 4) AS is_query,
                 CASE doc_id % 8 WHEN 3 THEN 'insert,into' WHEN 4 THEN 'drop' ELSE '' END AS forbidden_words,
                 CASE doc_id % 8 WHEN 2 THEN 'raw,silver' WHEN 5 THEN lang WHEN 6 THEN 'bronze' ELSE '' END AS foreign_schemas,
                 CASE doc_id % 8 WHEN 5 THEN source ELSE '' END AS unqualified
          FROM documents)
    """,
)
def sql_audit_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements that hold the text of every document as a literal, with its quotes doubled, or in a comment."""
    lang, source = F.col("lang"), F.col("source")
    text = F.translate("text", "\\`", "/.")
    literal = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("''")), F.lit("'"))
    remark = F.translate(text, "*\r\n", "   ")
    shapes = [
        F.concat(F.lit("select * from gold.fact_transaction where description = "), literal, F.lit(";")),
        F.concat(F.lit("with t as (select * from Marts.daily where note = "), literal, F.lit(") select * from t, `gold`.`"), lang, F.lit("` -- "), remark),
        F.concat(F.lit("select replace(x, "), literal, F.lit(", '') from (select * from raw."), source, F.lit(") s, silver."), lang),
        F.concat(F.lit("insert into gold."), lang, F.lit(" select "), literal),
        F.concat(F.lit("/* "), remark, F.lit(" */ select extract(year from ts) from gold.t; drop table gold."), lang),
        F.concat(F.lit("select a /* "), remark, F.lit(" */ from "), source, F.lit(" join gold.t on true, lake."), lang, F.lit(".u")),
        F.concat(F.lit("select `update`, "), literal, F.lit(" from lake . gold . t where k in (select k from bronze."), lang, F.lit(")")),
        F.concat(F.lit("```sql\nselect "), literal, F.lit(" from marts.m\n```")),
    ]
    return _audited(spark, sf_dir, shapes, strict=True)
