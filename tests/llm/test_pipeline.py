from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontaminate, langid, secrets, simhash
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def encoder():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def brute(spark, docs, benchmark, network):
    """The stages in order on plain lists."""
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    judged = [langid.language_of(network, r.text) for r in rows]
    rows = [r for r, (lang, score) in zip(rows, judged, strict=True) if lang != "und" and score >= 0.3]
    fps = [simhash.fingerprint(r.text) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    rows = [r for i, r in enumerate(rows) if group[i] == i]
    items = [decontaminate.normal(r.text) for r in benchmark.collect()]
    most = lambda item: int(decontaminate.ERROR_RATE * len(item))
    rows = [r for r in rows if not any(decontaminate.best_end(i, decontaminate.normal(r.text), most(i)) for i in items)]
    tool, out = encoder(), []
    for r in rows:
        text = secrets.mask(r.text, secrets.scan(r.text)[1], "[secret]")
        ids = np.array(tool.encode_ordinary(text), "<u4").tobytes()
        out.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids))
    return out


def test_run_against_brute_force(spark):
    docs, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    found = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    expected = brute(spark, docs, benchmark, langid.learn(docs))
    assert found == expected and 50 < len(found) < docs.count()


def test_each_stage_takes_effect_and_keeps_clean_rows(spark, documents):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    base = documents.filter(F.length("text") > 500)
    clean = corpus_pipeline.simhash_dedup(spark, base, SF).limit(30).collect()
    random.seed(1)
    rows = [tuple(r) for r in clean]
    make = lambda i, text: (i, text, "en", "src0", len(text))
    secret = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    rows += [make(10_000, "123 456"), make(10_001, clean[0].text), make(10_002, clean[1].text + " " + item), make(10_003, clean[2].text[::2] + " " + secret), (10_004, None, None, None, None)]
    docs = spark.createDataFrame(rows, documents.schema).repartition(3)
    steps = dict(corpus_pipeline.STAGES)

    one = steps["language ID"](spark, docs, SF)
    assert {r.doc_id for r in one.collect()} == {r[0] for r in rows} - {10_000, 10_004}
    two = steps["SimHash near-dedup"](spark, one, SF)
    gone = {r.doc_id for r in one.collect()} - {r.doc_id for r in two.collect()}
    assert 10_001 in gone and gone <= {10_001, 10_002}
    three = steps["benchmark decontamination"](spark, one, SF)
    assert 10_002 not in {r.doc_id for r in three.collect()}
    four = {r.doc_id: r for r in steps["secret scan"](spark, one, SF).collect()}
    assert len(four) == one.count() and secret not in four[10_003].text and four[10_003].n_chars == len(four[10_003].text)
    same = {r.doc_id: r.text for r in one.collect()}
    assert all(r.text == same[i] for i, r in four.items() if not secrets.scan(same[i])[1])
    for step in (one, two, three, steps["secret scan"](spark, one, SF)):
        assert step.columns == documents.columns


def test_empty_documents(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_all_queries_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and QUERIES["pipeline"] is corpus_pipeline.run


def test_stages_judge_each_row_by_its_own_text(spark, documents):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    a, b, c, d = (r.text for r in corpus_pipeline.simhash_dedup(spark, documents.filter(F.length("text") > 500), SF).limit(4).collect())
    make = lambda i, text: (i, text, "en", "src0", len(text))
    rows = [make(None, item + " and more"), make(None, a), make(None, a), make(None, a), make(7, b), make(7, c + " " + item), make(7, d), make(7, d), make(9, d), make(None, d)]
    docs = spark.createDataFrame(rows, documents.schema).repartition(3)
    steps = dict(corpus_pipeline.STAGES)
    key = lambda r: (r[0] or 0, r[1])
    unique = steps["SimHash near-dedup"](spark, docs, SF)
    assert sorted(((r.doc_id, r.text) for r in unique.collect()), key=key) == sorted([(None, item + " and more"), (None, a), (7, b), (7, c + " " + item), (7, d)], key=key)
    clean = steps["benchmark decontamination"](spark, unique, SF)
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=key) == sorted([(None, a), (7, b), (7, d)], key=key)
    assert unique.columns == clean.columns == documents.columns


def test_rows_stay_with_any_column_names(spark, documents, clashing, monkeypatch):
    docs = clashing(documents.limit(20), "id_", "digest", "first", "fp")
    assert simhash.one_of_each(docs).columns == docs.columns
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 5000)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = decontaminate.clean_rows(docs, benchmark)
    assert clean.columns == docs.columns
    leaks = {r.doc_id for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - leaks
