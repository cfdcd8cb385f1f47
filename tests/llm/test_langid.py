from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import langid


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def network(table):
    return langid.learn(table, max_rows=600)


def test_held_out_accuracy(table, network):
    found = langid.predict(table, network).join(table.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_labels_and_other_columns_do_not_matter(table, network):
    lied = table.withColumn("lang", F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("z")).repartition(7)
    again = langid.learn(lied, max_rows=600)
    assert again.languages == network.languages and "xx" not in again.languages
    for a, b in zip((again.embedding, again.filters, again.dense, again.bias), (network.embedding, network.filters, network.dense, network.bias), strict=True):
        assert np.array_equal(a, b)


def test_windows_cover_the_whole_text():
    for n in (0, 1, 255, 256, 257, 252, 508, 509, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        windows = langid.windows_of(text)
        step = langid.WINDOW - langid.OVERLAP
        joined = b"".join(w[:step].tobytes() for w in windows[:-1]) + windows[-1].tobytes()
        assert joined.rstrip(b"\0") == text.encode() and windows.shape[1] == langid.WINDOW


def test_gradients_against_differences():
    random = np.random.default_rng(1)
    windows, labels = random.integers(97, 105, (6, langid.WINDOW)).astype(np.uint8), random.integers(0, 3, 6)
    net = langid.train(windows, labels, ["a", "b", "c"], epochs=1, steps=1)
    for field in ("embedding", "filters", "shift", "dense", "bias"):
        setattr(net, field, getattr(net, field).astype(np.float64))
    open_rows = (net.filters != 0).astype(np.float64)
    loss = lambda: -np.log(net.probabilities(windows)[np.arange(6), labels]).mean()
    for values, grad in zip((net.embedding, net.filters, net.shift, net.dense, net.bias), langid._gradients(net, windows, labels, open_rows), strict=True):
        for at in random.choice(np.flatnonzero(np.abs(grad).ravel() > 1e-4), 3):
            flat, step = values.reshape(-1), 1e-6
            flat[at] += step
            up = loss()
            flat[at] -= 2 * step
            down = loss()
            flat[at] += step
            assert np.isclose((up - down) / (2 * step), grad.ravel()[at], rtol=1e-3, atol=1e-6)


def test_edge_rows(make_docs, clashing, network):
    rows = [(1, None), (2, ""), (3, "123 !? 456"), (4, "The and of that with and the from"), (None, "und der die das nicht mit auf ein"), (4, "The and of that with and the from"), (5, "the and with " * 20_000)]
    found = langid.predict(clashing(make_docs(rows), "lang_pred", "score", "held_out"), network).collect()
    assert len(found) == len(rows)
    for r in found:
        und = r.doc_id in (1, 2, 3)
        assert (r.lang_pred == "und" and r.score == 0) if und else (r.lang_pred in network.languages and 0 < r.score <= 1)
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
    kept = langid.confident_documents(clashing(make_docs(rows), "score"), network, 0.0)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 4, 5]


def test_nothing_to_learn_from(make_docs, spark):
    docs = make_docs([(1, "some text"), (2, None)])
    assert langid.learn(docs.limit(0)) is None
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.learn(unlabelled) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(docs.limit(0), None).collect() == []


def test_the_sample_is_bounded_whatever_repeats(spark, table, monkeypatch):
    """One id with a third of all rows, a row that repeats as often, and many languages of one row each."""
    hot = next(i for i in range(1, 99) if zlib.crc32(str(i).encode()) % 5)
    more = spark.range(3000).selectExpr(f"{hot}L AS doc_id", "concat('the row number ', id, ' of one id') AS text", "'en' AS lang")
    same = spark.range(3000).selectExpr(f"{hot}L AS doc_id", "'le document qui se répète' AS text", "'fr' AS lang")
    odd = spark.range(500).selectExpr("id + 10000 AS doc_id", "concat('text ', id) AS text", "concat('x', id) AS lang")
    docs = table.select("doc_id", "text", "lang").unionByName(more).unionByName(same).unionByName(odd)
    seen = []
    monkeypatch.setattr(langid, "train", lambda windows, labels, languages: seen.append((windows, labels, languages)))
    langid.learn(docs, max_rows=200, max_languages=20)
    windows, labels, languages = seen[0]
    assert 40 <= len(windows) <= 800 and len(languages) <= 20 and {"en", "fr"} <= set(languages)
    assert sum(w.tobytes().startswith("le document qui se répète\0".encode()) for w in windows) <= 1
