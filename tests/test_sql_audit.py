from __future__ import annotations

import pytest

from ledgerloom.operators.sql_audit import audit

CASES = {
    "plain": ("SELECT * FROM gold.dim_date", True, [], []),
    "with": (" \n with x as (select 1 from marts.m) select * from x;;", True, [], []),
    "fenced": ("Sure:\n```sql\nSELECT 1 FROM gold.t;\n```\nDROP everything", True, [], []),
    "bare fence": ("```select 1```", True, [], []),
    "drop": ("drop table gold.t", False, ["drop"], []),
    "hidden write": ("with x as (select 1) insert into gold.t select * from x", True, ["insert"], []),
    "updated_at is one word": ("select updated_at from gold.t", True, [], []),
    "replace call": ("select replace(a, 'b', 'c') from gold.t", True, ["replace"], []),
    "bronze": ("select * from bronze.t join GOLD.u using (k)", True, [], ["bronze"]),
    "three parts": ("select * from lake.silver.t join lake.gold.u", True, [], ["silver"]),
    "alias": ("select m.x from gold.t m", True, [], []),
    "unqualified": ("select * from t", True, [], []),
    "comma join": ("select * from gold.t, bronze.u", True, [], ["bronze"]),
    "comma join with aliases": ("select * from gold.t as a , gold.u b,lake.Silver.v c join raw.w", True, [], ["Silver", "raw"]),
    "back-quoted": ("select * from `bronze`.`t`", True, [], ["bronze"]),
    "no-break space": ("select * from\u00a0bronze.customers", True, [], ["bronze"]),
    "wide space": ("\u2003select * from gold.t\u3000join\u2009bronze.c", True, [], ["bronze"]),
    "columns are no tables": ("select a.x, b.y from gold.t a, gold.u b order by a.x, b.y", True, [], []),
    "two writes": ("MERGE into x; Delete from y", False, ["delete", "merge"], []),
    "empty": ("", False, [], []),
}


def test_rules(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "query_id string, sql_text string")
    for row in audit(df).collect():
        _, is_query, words, schemas = CASES[row.query_id]
        assert (row.is_query, row.forbidden_words, row.foreign_schemas) == (is_query, words, schemas), row.query_id
        assert row.accepted == (is_query and not words and not schemas), row.query_id


def test_bare_sql_and_tables(spark):
    df = spark.createDataFrame([(CASES["with"][0],), (CASES["three parts"][0],)], "sql_text string")
    first, second = audit(df).collect()
    assert first.sql == "with x as (select 1 from marts.m) select * from x"
    assert second.tables == ["lake.gold.u", "lake.silver.t"]


def test_other_schemas(spark):
    df = spark.createDataFrame([("select 1 from Bronze.t",)], "sql_text string")
    assert audit(df, allowed=["BRONZE"]).first().accepted


@pytest.mark.parametrize("text", [None])
def test_null_text(spark, text):
    assert not audit(spark.createDataFrame([(text,)], "sql_text string")).filter("accepted").count()


# text: whether it starts as one query, forbidden words, foreign schemas, names without schema
STRICT = {
    "plain": ("SELECT * FROM gold.dim_date;", True, [], [], []),
    "words in literals": ("select 'drop table x', \"insert from bronze.t\" from gold.t where a = 'it''s; update'", True, [], [], []),
    "words in comments": ("/* delete from bronze.x */ select 1 -- drop\nfrom gold.t", True, [], [], []),
    "literal that hides nothing": ("select '/*' from bronze.t where x = '*/'", True, [], ["bronze"], []),
    "quote in a comment": ("select 1 -- it's\n from bronze.t where x = 'y'", True, [], ["bronze"], []),
    "quote in a quoted name": ("select `it's` from bronze.t where x = 'a'", True, [], ["bronze"], []),
    "escaped quote": (r"select 'a\' from bronze.t' from gold.t", True, [], [], []),
    "open literal": ("select 1 from gold.t where a = 'drop", True, [], [], []),
    "replace call": ("select replace (a, 'b', 'c') from gold.t", True, [], [], []),
    "replace statement": ("with x as (select 1) replace into gold.t select * from x", True, ["into", "replace"], [], []),
    "select into": ("select * into gold.copy_of from gold.t", True, ["into"], [], []),
    "column named by a word": ("select `update`, t.delete from gold.t", True, [], [], []),
    "two statements": ("select 1 from gold.t; select 2 from gold.u", False, [], [], []),
    "unqualified": ("select * from t join gold.u", True, [], [], ["t"]),
    "common tables": ("with a as (select 1 from gold.t), b (x, y) as (select * from A) select * from a join b on true, `b`", True, [], [], []),
    "common table over a foreign one": ("with a as (select 1 from bronze.t) select * from a, c", True, [], ["bronze"], ["c"]),
    "comma after a condition": ("select * from gold.t join gold.u on t.x = u.x, bronze.v", True, [], ["bronze"], []),
    "comma after a subquery": ("select * from (select 1, 2 from gold.t) s, raw.v", True, [], ["raw"], []),
    "list in brackets": ("select * from (gold.t cross join (raw.u, gold.v))", True, [], ["raw"], []),
    "subquery in a condition": ("select a, b from gold.t where x in (select y, z from silver.u) order by a, b", True, [], ["silver"], []),
    "deep": ("select " + "(" * 60 + "select 1 from bronze.x" + ")" * 60 + " from gold.t", True, [], ["bronze"], []),
    "blanks around dots": ("select * from lake . `silver` .\n t", True, [], ["silver"], []),
    "dot within one name": ("select * from `gold.t`", True, [], [], ["gold.t"]),
    "columns are no tables": ("select a.x, b.y from gold.t a, gold.u as b group by a.x, b.y", True, [], [], []),
    "from within functions": ("select extract(year from d), trim(both 'x' from e), a is distinct from b from gold.t", True, [], [], []),
    "function that gives rows": ("select * from range(10) r, gold.t lateral view explode(m) v as k, w", True, [], [], []),
    "function of a schema": ("select * from raw.rows_of(10)", True, [], ["raw"], []),
    "derived by union": ("select 1 from gold.t union all select 2 from marts.m, other.o", True, [], ["other"], []),
    "no-break space": ("select * from\u00a0bronze.customers", True, [], ["bronze"], []),
    "starts alike": ("selection from gold.t", False, [], [], []),
    "fenced": ("Sure:\n```sql\nSELECT 1 FROM gold.t;\n```\nDROP everything", True, [], [], []),
    "empty": ("", False, [], [], []),
}


def test_strict_rules(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in STRICT.items()], "query_id string, sql_text string")
    rows = audit(df, strict=True).collect()
    assert len(rows) == len(STRICT)
    for row in rows:
        _, is_query, words, schemas, names = STRICT[row.query_id]
        assert (row.is_query, row.forbidden_words, row.foreign_schemas, row.unqualified) == (is_query, words, schemas, names), row.query_id
        assert row.accepted == (is_query and not words and not schemas and not names), row.query_id


def test_strict_on_long_texts(spark):
    """A literal, a comment and a condition of a megabyte each, quotes and escapes included."""
    filler = "it''s \\' drop -- " * 50_000
    sql = f"select '{filler}' /* {filler} */ from gold.t where x in ({', '.join(map(str, range(20_000)))}) and y in (select 1 from bronze.u)"
    row = audit(spark.createDataFrame([(sql,), (None,)], "sql_text string"), strict=True).filter("sql IS NOT NULL").first()
    assert (row.is_query, row.forbidden_words, row.tables, row.unqualified) == (True, [], ["bronze.u", "gold.t"], [])


def test_columns_of_the_same_name_are_replaced(spark):
    df = spark.createDataFrame([("select 1 from gold.t", "x", "y")], "sql_text string, sql string, tables string")
    for strict in (False, True):
        assert audit(df, strict=strict).select("sql", "tables").first() == ("select 1 from gold.t", ["gold.t"])
