from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture
def make_docs(spark):
    """Documents of (doc_id, text) pairs, with the other columns filled in."""

    def make(rows):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture
def clashing(spark):
    """Adds columns whose names an operator might use itself, and one that needs quoting."""

    def add(df, *names):
        from pyspark.sql import functions as F

        taken = set(df.columns)
        return df.withColumns({n: F.lit("x") for n in (*names, "a.b") if n not in taken})

    return add
