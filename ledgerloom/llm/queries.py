"""The operators of this subpackage bound to the shared test tables with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ledgerloom.llm import bpe, decontaminate, html, langid, minhash, quality, secrets, seqfile, simhash, spelling, suffixdedup, topk, whitening
from ledgerloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan_documents(table(spark, sf_dir, "documents")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digests(suffixdedup.remove_repeats(table(spark, sf_dir, "documents")))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode_documents(encoded, ranks))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The site of a document is its source as host and its language there as path."""
    docs = table(spark, sf_dir, "documents").withColumnsRenamed({"source": "host", "lang": "path"})
    return quality.score(docs, table(spark, sf_dir, "labels"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.counted(html.extract(table(spark, sf_dir, "pages")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)


def op9_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seqfile.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_decontaminate": op2_decontaminate,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_topk": op6_topk,
    "op7_html": op7_html,
    "op8_simhash": op8_simhash,
    "op9_sequences": op9_sequences,
    "op10_langid": op10_langid,
    "op11_spelling": op11_spelling,
    "op12_minhash": op12_minhash,
    "op13_whitening": op13_whitening,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB SQL of the queries that SQL can state over whole tables.
ORACLES: dict[str, str] = {
    "op6_topk": """
        WITH v AS (
            SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS c
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, o.vec_id, CAST(list_inner_product(q.c, o.c) AS BIGINT) AS score
            FROM v q JOIN v o ON q.vec_id <> o.vec_id
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    # The CRC-32 of document and run goes over the UTF-8 bytes with a table of 256 steps made from the polynomial.
    "op11_spelling": """
        WITH RECURSIVE crc AS (
            SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
            FROM (SELECT unnest(range(256)) AS i)
        ), r AS (
            SELECT doc_id, run, count(*) AS c
            FROM (
                SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
                       unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run
                FROM documents
            )
            WHERE length(run) >= 7
            GROUP BY doc_id, run
        ), b AS (
            SELECT run, c, flatten([CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END
                                    FOR u IN [CAST(unicode(x) AS BIGINT) FOR x IN string_split(doc_id || ':' || run, '')]]) AS bytes
            FROM r
        ), h AS (
            SELECT run, c, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, x: xor(a >> 8, steps[1 + (xor(a, x) & 255)])), 4294967295) AS h
            FROM b CROSS JOIN crc
        ), w AS (
            SELECT CASE WHEN h % 31 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
            FROM h GROUP BY 1 HAVING sum(c) >= 2 AND length(word) >= 7
        ), d AS (
            SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
        ), near AS (
            SELECT a.word, b.word AS other, b.n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM d a JOIN w b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM d a JOIN w b ON a.rest = b.word
        ), best AS (
            SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, other)) AS other FROM near GROUP BY word
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * w.n THEN other END AS form, CASE WHEN top >= 10 * w.n THEN top END AS form_n
            FROM w LEFT JOIN best ON w.word = best.word
        ), chain AS (
            SELECT word, word AS root, form AS next FROM formed
            UNION ALL SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON chain.next = formed.word
        )
        SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN chain ON formed.word = chain.word AND chain.next IS NULL
    """,
    "op12_minhash": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                           ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s
            FROM w
        ), e AS (
            SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s
        ), link AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reached AS (
            SELECT a, b FROM link
            UNION SELECT reached.a, link.b FROM reached JOIN link ON reached.b = link.a
        ), least AS (
            SELECT a, min(b) AS b FROM reached GROUP BY a
        )
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
        FROM s LEFT JOIN least ON doc_id = a
    """,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
