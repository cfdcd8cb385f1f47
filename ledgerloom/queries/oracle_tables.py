"""DuckDB SQL for the stand-in datasets, written independently of the Spark code.

:func:`sql` puts the tables a query needs in front of it as common table expressions.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {
    "raw_customers": """
        SELECT c_custkey AS customer_id,
               ' ' || split_part(c_name, '#', 1) || ' ' AS first_name,
               ' ' || split_part(c_name, '#', 2) AS last_name,
               ' ' || upper(replace(c_name, '#', '.')) || '@EXAMPLE.COM  ' AS email,
               CAST(c_custkey AS VARCHAR) AS phone,
               CAST(CAST(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS DATE) AS VARCHAR) AS date_of_birth,
               '  ' || lower(n_name) || ' ' AS country,
               TIMESTAMP '1990-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER)) AS created_at,
               TIMESTAMP '1990-01-01' + to_days(CAST(c_custkey % 1000 + c_custkey % 37 AS INTEGER)) AS updated_at,
               CASE WHEN c_acctbal < 0 THEN ' INACTIVE  ' ELSE ' ACTIVE  ' END AS customer_status
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "raw_accounts": """
        SELECT o_orderkey AS account_id, o_custkey AS customer_id,
               CASE o_orderkey % 3 WHEN 0 THEN ' CHECKING  ' WHEN 1 THEN ' SAVINGS  ' ELSE ' INVESTMENT  ' END
                   AS account_type,
               CASE o_custkey % 4 WHEN 0 THEN '  inr ' WHEN 1 THEN '  usd ' WHEN 2 THEN '  eur ' ELSE '  gbp ' END
                   AS currency,
               o_totalprice AS balance,
               CASE o_orderstatus WHEN 'O' THEN ' ACTIVE  ' WHEN 'P' THEN ' INACTIVE  ' WHEN 'F' THEN ' FROZEN  ' END
                   AS account_status,
               o_orderdate AS opened_at,
               o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS updated_at
        FROM orders""",
    "raw_merchants": """
        SELECT s_suppkey AS merchant_id, '  ' || s_name || ' ' AS merchant_name,
               ' CATEGORY_' || s_suppkey % 10 || '  ' AS merchant_category,
               '  ' || lower((['IN','US','GB','DE','AE','SG'])[1 + s_nationkey % 6]) || ' ' AS country,
               n_name AS city,
               (['INR','USD','GBP','EUR','AED','SGD'])[1 + s_nationkey % 6] AS currency,
               CASE WHEN s_acctbal < 0 THEN ' INACTIVE  ' ELSE ' ACTIVE  ' END AS merchant_status,
               TIMESTAMP '1990-01-01' + to_days(CAST(s_suppkey % 500 AS INTEGER)) AS created_at,
               TIMESTAMP '1990-01-01' + to_days(CAST(s_suppkey % 500 + s_suppkey % 45 AS INTEGER)) AS updated_at
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "currency_places": """
        SELECT * FROM (VALUES (1, 'INR'), (2, 'USD'), (3, 'EUR'), (4, 'GBP'), (5, 'AED'), (6, 'SGD')) AS t(place, currency)""",
    "base_rates": """
        SELECT row_number() OVER (ORDER BY b.place, t.place) AS pair, b.currency AS base, t.currency AS target,
               CAST(b.place AS DOUBLE) / t.place AS rate
        FROM currency_places AS b JOIN currency_places AS t ON b.place <> t.place""",
    "grid": """
        SELECT 'fx_' || lpad(CAST(30 * date_diff('day', DATE '1995-01-01', d.day) + pair AS VARCHAR), 8, '0')
                   AS exchange_rate_id,
               base, target, CAST(rate AS DOUBLE) AS base_rate, d.day AS rate_date
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) AS d, base_rates""",
    "raw_exchange_rates": """
        SELECT exchange_rate_id, '  ' || lower(base) || ' ' AS base_currency, '  ' || lower(target) || ' ' AS target_currency,
               base_rate * (CAST(0.995 AS DOUBLE) + CAST(0.001 AS DOUBLE) * (day(rate_date) % 11)) AS rate,
               CAST(rate_date AS VARCHAR) AS rate_date, 'synthetic_provider' AS source
        FROM grid""",
    "raw_transactions": """
        SELECT l_orderkey || '-' || l_linenumber AS transaction_id, l_orderkey AS account_id,
               CASE WHEN l_linenumber % 5 IN (0, 4) AND NOT (l_tax = 0 AND l_discount = 0) THEN l_suppkey END
                   AS merchant_id,
               l_shipdate + to_seconds(l_partkey % 86400) AS transaction_timestamp,
               ' ' || (['PURCHASE','WITHDRAWAL','DEPOSIT','TRANSFER','PAYMENT'])[1 + l_linenumber % 5] || '  '
                   AS transaction_type,
               l_extendedprice AS amount,
               '  ' || (['inr','usd','eur','gbp','aed','sgd'])[1 + l_suppkey % 6] || ' ' AS currency,
               CASE WHEN l_returnflag = 'A' THEN ' COMPLETED  ' WHEN l_returnflag = 'N' THEN ' PENDING  '
                    WHEN l_linestatus = 'F' THEN ' FAILED  ' ELSE ' REVERSED  ' END AS transaction_status,
               ' ' || (['CARD','UPI','BANK_TRANSFER','CASH','ONLINE'])[1 + l_partkey % 5] || '  ' AS payment_method,
               'part ' || l_partkey AS description
        FROM lineitem""",
    "raw_transaction_events": """
        SELECT event_id, user_id || '-' || (1 + event_id % 7) AS transaction_id,
               CASE event_type WHEN 'error' THEN ' FAILED  ' WHEN 'signup' THEN ' INITIATED  '
                    WHEN 'view' THEN ' AUTHORIZED  ' WHEN 'purchase' THEN ' COMPLETED  '
                    WHEN 'click' THEN ' REVERSED  ' END AS event_type,
               ts AS event_timestamp,
               CASE WHEN event_type = 'error' THEN ' FAILURE  ' ELSE ' SUCCESS  ' END AS event_status,
               CASE WHEN event_type = 'error' AND k >= 5 THEN ' REASON_' || k % 5 || '  ' END AS failure_reason
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)""",
    "silver_customers": """
        SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
               lower(trim(email)) AS email, phone, CAST(date_of_birth AS DATE) AS date_of_birth,
               upper(trim(country)) AS country, created_at, updated_at,
               lower(trim(customer_status)) AS customer_status
        FROM raw_customers""",
    "silver_accounts": """
        SELECT account_id, customer_id, lower(trim(account_type)) AS account_type, upper(trim(currency)) AS currency,
               balance, lower(trim(account_status)) AS account_status, opened_at, updated_at
        FROM raw_accounts""",
    "silver_merchants": """
        SELECT merchant_id, trim(merchant_name) AS merchant_name, lower(trim(merchant_category)) AS merchant_category,
               upper(trim(country)) AS country, city, currency, merchant_status, created_at, updated_at,
               lower(trim(merchant_status)) AS status
        FROM raw_merchants""",
    "silver_exchange_rates": """
        SELECT exchange_rate_id, base_currency, target_currency, rate, CAST(rate_date AS DATE) AS rate_date, source,
               upper(trim(base_currency)) AS from_currency, upper(trim(target_currency)) AS to_currency
        FROM raw_exchange_rates""",
    "silver_transactions": """
        SELECT transaction_id, account_id, merchant_id, transaction_timestamp,
               lower(trim(transaction_type)) AS transaction_type, CAST(amount AS DECIMAL(18,2)) AS amount,
               upper(trim(currency)) AS currency, lower(trim(transaction_status)) AS transaction_status,
               lower(trim(payment_method)) AS payment_method, description
        FROM raw_transactions""",
    "silver_transaction_events": """
        SELECT event_id, transaction_id, lower(trim(event_type)) AS event_type, event_timestamp,
               lower(trim(event_status)) AS event_status, lower(trim(failure_reason)) AS failure_reason
        FROM raw_transaction_events""",
    "stg_transactions": """
        SELECT *, CAST(transaction_timestamp AS DATE) AS transaction_date FROM silver_transactions""",
    "stg_transaction_events": """
        SELECT *, CAST(event_timestamp AS DATE) AS event_date FROM silver_transaction_events""",
    "days": """
        SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day AS full_date,
               CAST(year(day) AS INTEGER) AS year, CAST(quarter(day) AS INTEGER) AS quarter,
               CAST(month(day) AS INTEGER) AS month, strftime(day, '%B') AS month_name,
               CAST(weekofyear(day) AS INTEGER) AS week_of_year, CAST(day(day) AS INTEGER) AS day,
               strftime(day, '%A') AS day_name, dayofweek(day) IN (0, 6) AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day)""",
    "facts": """
        SELECT t.transaction_id, t.account_id, o.o_custkey AS customer_id, t.merchant_id, d.date_key,
               t.transaction_timestamp, t.transaction_date, t.transaction_type, t.amount, t.currency,
               t.transaction_status, t.payment_method, t.description
        FROM stg_transactions t
        LEFT JOIN orders o ON o.o_orderkey = t.account_id
        LEFT JOIN days d ON d.full_date = t.transaction_date""",
    "event_facts": """
        SELECT event_id, transaction_id, event_date, event_timestamp, event_type, event_status, failure_reason,
               CASE WHEN event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
                    THEN CAST(strftime(event_date, '%Y%m%d') AS INTEGER) END AS date_key
        FROM stg_transaction_events""",
}


def _needed(text: str) -> set[str]:
    return {name for name in TABLES if re.search(rf"\b{name}\b", text)}


def sql(query: str) -> str:
    """The query with the stand-in tables it mentions, directly or through others."""
    wanted: set[str] = set()
    found = _needed(query)
    while found - wanted:
        wanted |= found
        found = set().union(*(_needed(TABLES[name]) for name in wanted)) | wanted
    if not wanted:
        return query
    body = ", ".join(f"{name} AS ({text})" for name, text in TABLES.items() if name in wanted)
    return f"WITH {body} {query}"
