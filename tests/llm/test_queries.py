"""Every query of the subpackage over the smallest tables, against its SQL or the rows that its contract names."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from compare import rows_of

from ledgerloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# Columns of the contracts, and the table that has one row for each row of the result.
CONTRACTS = {
    "op1_secrets": ("documents", {"doc_id": "bigint", "n_assign": "bigint", "n_access": "bigint", "n_hex": "bigint", "base_sha256": "string", "spans": "string"}),
    "op2_decontaminate": (None, {"doc_id": "bigint", "item_id": "bigint"}),
    "op3_suffix_dedup": ("documents", {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}),
    "op4_bpe": ("documents", {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}),
    "op5_quality": ("documents", {"doc_id": "bigint", "score": "double", "keep": "boolean"}),
    "op6_topk": (None, {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}),
    "op7_html": ("pages", {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"}),
    "op8_simhash": ("documents", {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}),
    "op9_sequences": ("documents", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
    "op10_langid": ("documents", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
    "op11_spelling": (None, {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}),
    "op12_minhash": ("documents", {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"}),
    "op13_whitening": (None, {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}),
}


@pytest.mark.parametrize("name", CONTRACTS)
def test_query(spark, name):
    of, columns = CONTRACTS[name]
    df = QUERIES[name](spark, SF)
    assert columns.items() <= dict(df.dtypes).items()
    rows = df.collect()
    if of:
        assert len(rows) == spark.read.parquet(f"{SF}/{of}.parquet").count()
    if name in ORACLES:
        connection = duckdb.connect()
        for path in Path(SF).glob("*.parquet"):
            connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        relation = connection.sql(ORACLES[name])
        assert rows_of(df.columns, rows) == rows_of(relation.columns, relation.fetchall()) and sorted(df.columns) == sorted(relation.columns)
