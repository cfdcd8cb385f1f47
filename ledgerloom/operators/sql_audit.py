"""Read-only audit of a table of SQL texts.

A guard, not a parser: it applies the same three rules to every text as column expressions, over
the whole text, so millions of generated statements are audited in one pass of the table.

The strict form first blanks literals and comments, then follows the names and brackets that are left
with one fold: which names stand where a table may stand, however deep. Names of common tables are known;
any other name without a schema is a finding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip

# Words that mark a statement as a write, and the schemas that may be read.
FORBIDDEN = [
    "insert", "update", "delete", "drop", "alter", "truncate", "merge",
    "create", "grant", "revoke", "replace", "copy", "vacuum", "optimize",
]
ALLOWED_SCHEMAS = ["gold", "marts"]
START = r"^(select|with)"
WORD = r"[A-Za-z_][A-Za-z0-9_]*"

# A list of tables as it stands after FROM or JOIN: names with dots, in back-quotes or not, an alias after each. Space is
# any Unicode space, as a no-break space separates words for a database too.
_PART = r"(?:[\p{L}_][\p{L}\p{N}_$]*|`[^`]*`)"
_NAME = rf"{_PART}(?:\.{_PART})*"
_ITEM = rf"{_NAME}(?:\s+(?:as\s+)?(?!(?:from|join)\b){_PART})?"
CLAUSE = r"(?i)\b(?:from|join)(?=[\s\p{Z}\x85])"
TABLES = rf"(?iU)^\s+({_ITEM}(?:\s*,\s*{_ITEM})*)"
FIRST_NAME = rf"(?U)^\s*({_NAME})"


def bare_sql(text: Column) -> Column:
    """What stands in the first code fence, without its language, or the whole text; without trailing semicolons."""
    pieces = F.split(text, "```")
    inside = F.regexp_replace(F.get(pieces, F.lit(1)), "^sql", "")
    return F.rtrim(strip(F.when(F.size(pieces) > 2, inside).otherwise(text)), F.lit(";"))


def referenced_tables(sql: Column) -> Column:
    """Names with a schema in the table lists of a statement, back-quotes removed."""
    # What follows each clause word is tried from its start only; most of a text is passed over.
    lists = F.transform(F.slice(F.split(sql, CLAUSE), 2, 1 << 30), lambda rest: F.regexp_extract(rest, TABLES, 1))
    items = F.flatten(F.transform(lists, lambda found: F.split(found, ",")))
    names = F.transform(items, lambda item: F.replace(F.regexp_extract(item, FIRST_NAME, 1), F.lit("`"), F.lit("")))
    return F.filter(names, lambda name: name.contains("."))


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


# Quoted names stay; literals and comments, closed or not, go. Every part reads on without looking back.
_BLANKED = r"""(`[^`]*+`)|'[^']*+(?:'|\z)|"[^"]*+(?:"|\z)|--[^\n]*+|/\*(?s:.*?)(?:\*/|\z)"""
_PATH = rf"(?U)(?<![\w$]){_PART}(?:\s*\.\s*{_PART})*|[(),]"
_COMMON = rf"(?iU)(?:\bwith(?:\s+recursive)?|,)\s*({_PART})\s*(?:\([^()]*+\)\s*)?as\s*(?:not\s+)?(?:materialized\s*)?\("
#: Words that end a list of tables, and functions whose arguments are set apart by FROM.
_ENDS = ["where", "group", "having", "order", "limit", "offset", "fetch", "union", "intersect", "except", "minus", "window", "qualify", "sort", "cluster", "distribute", "lateral", "select"]
_FROM_FUNCTIONS = ["extract", "trim", "substring", "overlay", "position"]


def code(sql: Column) -> Column:
    """The statement without its literals and comments. A backslash protects the character after it, as in Spark."""
    return F.regexp_replace(F.regexp_replace(sql, r"\\.", "  "), _BLANKED, "$1 ")


def _step(state: Column, token: Column) -> Column:
    """Next state after a name or bracket.

    ``mode`` is table (a table may come), list (after one), function (FROM is no clause here) or other; ``outer``
    holds the modes of the open brackets; ``fresh`` tells that the last token was taken as a table.
    """
    word, mode, outer, tables = F.lower(token), state["mode"], state["outer"], state["tables"]
    opens, closes, comma = token == "(", token == ")", token == ","
    clause = word.isin("from", "join") & (mode != "function") & ~((word == "from") & (state["before"] == "distinct"))
    query = word.isin("select", "with", "values")
    taken = (mode == "table") & ~(opens | closes | comma | clause | query | word.isin("lateral", "only"))
    # What a bracket follows is a function that gives rows, not a table, unless a schema is named.
    called = opens & state["fresh"] & ~F.element_at(tables, -1).contains(".")
    back = F.get(outer, F.size(outer) - 1)
    following = (
        F.when(opens, F.when(mode == "table", "table").when(state["before"].isin(_FROM_FUNCTIONS), "function").otherwise("other"))
        .when(closes, F.when(back == "table", "list").otherwise(F.coalesce(back, F.lit("other"))))
        .when(comma, F.when(mode == "list", "table").otherwise(mode))
        .when(clause, "table")
        .when(taken, "list")
        .when((mode == "table") & query, "other")
        .when((mode == "list") & word.isin(_ENDS), "other")
        .otherwise(mode)
    )
    depth = F.when(opens, F.concat(outer, F.array(mode))).when(closes & (F.size(outer) > 0), F.slice(outer, 1, F.greatest(F.size(outer) - 1, F.lit(0)))).otherwise(outer)
    named = F.when(taken, F.concat(tables, F.array(token))).when(called, F.slice(tables, 1, F.greatest(F.size(tables) - 1, F.lit(0)))).otherwise(tables)
    return F.struct(following.alias("mode"), depth.alias("outer"), named.alias("tables"), taken.alias("fresh"), word.alias("before"))


def table_paths(statement: Column) -> Column:
    """Every name that stands for a table in a statement without literals and comments, as it is written."""
    none = F.array().cast("array<string>")
    start = F.struct(F.lit("other").alias("mode"), none.alias("outer"), none.alias("tables"), F.lit(False).alias("fresh"), F.lit("").alias("before"))
    return F.aggregate(F.regexp_extract_all(statement, F.lit(_PATH), F.lit(0)), start, _step, lambda state: state["tables"])


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns that later expressions read without computing them again."""
    df = df.drop(*columns)
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _unquoted(name: Column) -> Column:
    return F.replace(name, F.lit("`"), F.lit(""))


def audit(df: DataFrame, text: str = "sql_text", allowed: Sequence[str] = tuple(ALLOWED_SCHEMAS), strict: bool = False) -> DataFrame:
    """Add the bare SQL, the finding of each rule and the verdict to every row.

    ``forbidden_words``, ``foreign_schemas`` and ``unqualified`` are sorted lists; a text is accepted when it starts
    as a query and all are empty.

    By default words count wherever they stand, and the schema rule does not see unqualified names, blanks around the dots
    of a name, and tables after a bracket in a list. With ``strict`` literals, comments and quoted names hold no words, the
    function replace() is none, INTO is one, a second statement is refused, tables are found within brackets and after
    them, and a name without schema must be that of a common table.
    """
    permitted = _literals([a.lower() for a in allowed])
    df = _once(df, sql=bare_sql(F.col(text)))
    if strict:
        df = _once(df, __code=F.trim(code(F.col("sql"))))
        plain = F.regexp_replace(F.regexp_replace(F.lower("__code"), "`[^`]*`", " "), r"\breplace\s*\(", "(")
        words = F.regexp_extract_all(plain, F.lit(rf"(?<![\w$.]){WORD}"), F.lit(0))
        writes, is_query = [*FORBIDDEN, "into"], F.lower("__code").rlike(START + r"\b") & ~F.contains("__code", F.lit(";"))
        common = F.transform(F.regexp_extract_all("__code", F.lit(_COMMON), F.lit(1)), lambda name: F.lower(_unquoted(name)))
        df = _once(df, __paths=F.transform(table_paths(F.col("__code")), lambda path: F.transform(F.regexp_extract_all(path, F.lit(_PART), F.lit(0)), _unquoted)), __common=common)
        tables = F.transform("__paths", lambda parts: F.array_join(parts, "."))
        schemas = F.transform(F.filter("__paths", lambda parts: F.size(parts) > 1), lambda parts: F.element_at(parts, -2))
        alone = F.transform(F.filter("__paths", lambda parts: F.size(parts) == 1), lambda parts: parts[0])
        unqualified = F.filter(alone, lambda name: ~F.array_contains(F.col("__common"), F.lower(name)))
    else:
        lowered = F.lower(strip(F.col("sql")))
        df = _once(df, __code=lowered, __paths=referenced_tables(F.col("sql")))
        words, writes, is_query = F.regexp_extract_all("__code", F.lit(WORD), F.lit(0)), FORBIDDEN, F.col("__code").rlike(START)
        tables = F.col("__paths")
        schemas = F.transform("__paths", lambda r: F.element_at(F.split(r, r"\."), -2))
        unqualified = F.array().cast("array<string>")
    foreign = F.filter(schemas, lambda s: ~F.array_contains(permitted, F.lower(s)))
    df = _once(
        df,
        is_query=is_query,
        forbidden_words=F.array_sort(F.array_intersect(_literals(writes), words)),
        tables=F.array_sort(F.array_distinct(tables)),
        foreign_schemas=F.array_sort(F.array_distinct(foreign)),
        unqualified=F.array_sort(F.array_distinct(unqualified)),
    )
    clean = (F.size("forbidden_words") == 0) & (F.size("foreign_schemas") == 0) & (F.size("unqualified") == 0)
    return df.withColumn("accepted", F.col("is_query") & clean).drop("__code", "__paths", "__common")
