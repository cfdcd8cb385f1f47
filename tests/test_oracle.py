"""Every registered query on the smallest test tables, compared with its SQL where there is any."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import rows_of
from ledgerloom.queries import registries
from tests.conftest import SF_DIR

# The queries of optional subpackages have tests beside them.
QUERIES = {name: query for registry in registries() for name, query in registry.queries.items()}
ORACLES = {name: text for registry in registries() for name, text in registry.oracles.items()}


@pytest.fixture(scope="module")
def connection():
    found = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        found.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return found


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, df.collect())
    assert got
    if name in ORACLES:
        relation = connection.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(relation.columns)
        assert got == rows_of(relation.columns, relation.fetchall())


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
