"""Documents to token ids in five stages, each one operator of ``ledgerloom.llm`` over all that the last one kept.

    language ID -> SimHash near-dedup -> benchmark decontamination -> secret scan -> byte-level BPE

Every stage is a function of (spark, docs, sf_dir). All but the last give rows of documents with its columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontaminate, langid, secrets, simhash
from ledgerloom.llm.common import table
from ledgerloom.session import scratch_dir

#: A text whose best language has less of the probability is rejected, like one without letters. One that is half in one
#: language and half in another has some 0.5 and stays.
MIN_LANGUAGE_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from their labels; null texts and texts without letters go."""
    return langid.confident_documents(docs, langid.learn(docs), MIN_LANGUAGE_SCORE)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows the one with the smallest doc_id."""
    return simhash.one_of_each(docs, shingle=4, max_distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no item of the benchmark, small edits allowed for."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars counted again."""
    return secrets.mask_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids): the ids, and digests of them and of what they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    decoded = bpe.decode_documents(bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN), ranks)
    return bpe.digests(decoded, "ids")


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scan", secret_scan),
    ("byte-level BPE", token_ids),
]

#: No stage can be stated in SQL; tests/llm/test_pipeline.py compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written below spark.checkpoint.dir and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
