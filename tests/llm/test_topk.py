from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import topk


def test_threshold_search_against_sorting():
    random = np.random.default_rng(0)
    for _ in range(200):
        n, d, q, k = random.integers(1, 60), random.integers(1, 6), random.integers(1, 5), int(random.integers(1, 8))
        candidates, queries = random.integers(-4, 5, (n, d)), random.integers(-4, 5, (q, d))
        ids = random.permutation(100)[:n].astype(np.int64)
        found = {i: (a.tolist(), b.tolist()) for i, a, b in topk.threshold_search(candidates, ids, queries, k)}
        for i in range(q):
            scores = candidates @ queries[i]
            order = np.lexsort((ids, -scores))[:k]
            assert found[i] == (ids[order].tolist(), scores[order].tolist())


def test_it_stops_before_the_end():
    candidates = np.zeros((5000, 2), dtype=np.int64)
    candidates[:10] = [[1000 - i, 0] for i in range(10)]

    class Counting(np.ndarray):
        scored = 0

    seen = []
    original = np.flatnonzero

    def counting(x):
        out = original(x)
        seen.append(len(out))
        return out

    np.flatnonzero = counting
    try:
        ((_, ids, _),) = topk.threshold_search(candidates, np.arange(5000), np.array([[1, 0]]), 3)
    finally:
        np.flatnonzero = original
    assert ids.tolist() == [0, 1, 2] and sum(seen) < 500


def brute(rows, k, scale=256):
    usable = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (query, a) in enumerate(usable):
        if query % 5:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for other, (i, b) in enumerate(usable) if other != at)
        out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def search(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3).withColumns({"score": F.lit(1), "v": F.lit(2), "q": F.lit(3)})
    found = topk.search(df, F.col("vec_id") % 5 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def test_rows_of_all_kinds(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 7)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    random = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(random.integers(-3, 4, 4) / 8)]) for i in range(40)]
    rows += [(50, None), (55, [1.0, None, 0.0, 0.0]), (60, [float("nan"), 0.0, 0.0, 0.0]), (65, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    rows += [rows[10], rows[3], (70, []), (75, [0.5, 0.5])]
    assert search(spark, rows) == brute(rows, 5)


def test_fewer_candidates_than_k_and_none(spark):
    assert search(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 131072)]
    assert search(spark, [(0, [1.0])]) == []
    assert search(spark, [(1, [1.0])]) == []
