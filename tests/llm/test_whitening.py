from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import qd, whitening

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def matrices():
    rng = np.random.default_rng(4)

    def turned(values):
        n = len(values)
        left, right = (np.linalg.qr(rng.standard_normal((n, n)))[0] for _ in range(2))
        return left @ np.diag(values) @ right

    yield from (np.triu(rng.standard_normal((n, n))) for n in (1, 2, 3, 9, 64))
    yield from (np.zeros((4, 4)), np.eye(12), np.ones((7, 7)), np.diag(np.arange(1.0, 20)), rng.standard_normal((3, 10)))
    yield from (turned([5.0] * 6 + [3, 3, 2] + [1] * 20), turned([5 + 1e-9 * i for i in range(9)] + [1] * 9), turned([1, 1e-6, 0, 0, 0]))
    yield np.diag(10.0 ** -np.arange(8)) @ np.linalg.qr(rng.standard_normal((8, 8)))[0]
    yield from (scale * rng.standard_normal((12, 12)) for scale in (1e120, 1e-120))


@pytest.mark.parametrize("a", list(matrices()), ids=lambda a: f"{a.shape[0]}x{a.shape[1]}")
def test_solver(a):
    s, v = qd.leading_right_vectors(a, 8)
    scale = max(float(np.abs(a).max()), 1e-300)
    a = a / scale
    true = np.linalg.svd(a, compute_uv=False) ** 2
    true = np.concatenate([true, np.zeros(a.shape[1] - len(true))])[:8]
    assert np.allclose(s / scale / scale, true, rtol=1e-12, atol=1e-14 * true[0])
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-11
    assert np.linalg.norm(a.T @ (a @ v) - v * true, axis=0).max() <= 1e-13 * max(1.0, true[0]) * a.shape[1]


def test_bidiagonal_form():
    a = np.random.default_rng(0).standard_normal((9, 9))
    d, e, v = qd.bidiagonalised(a)
    b = np.diag(d) + np.diag(e, 1)
    assert np.allclose(b.T @ b, v.T @ a.T @ a @ v, atol=1e-12) and np.allclose(v.T @ v, np.eye(9), atol=1e-14)


def test_small_singular_values_are_relatively_accurate():
    d, e = 10.0 ** -np.arange(12.0), 0.3 * 10.0 ** -np.arange(11.0)
    b = [[Fraction(d[i]) if i == j else Fraction(e[i]) if j == i + 1 else Fraction(0) for j in range(12)] for i in range(12)]
    found = qd.squared_singular_values(d, e)
    product = math.prod(Fraction(x) ** 2 for x in d.tolist())  # of all squared values: the squared determinant
    assert abs(math.prod(map(Fraction, found.tolist())) / product - 1) < 1e-12
    assert abs(sum(map(Fraction, found.tolist())) / sum(x * x for row in b for x in row) - 1) < 1e-14


def brute(rows, k=8):
    """{position of the row: its deviation}, n, eigenvalues and whitened coordinates by numpy's eigenvectors."""
    kept = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, x = len(kept), np.array([v for _, v in kept], dtype=object)
    total = x.sum(axis=0)
    deviations = [sum(d * d for d in (n * v - total).tolist()) for v in x]
    centred = (n * x - total).astype(np.float64) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return [i for i, _ in kept], n, deviations, values, centred @ vectors / np.sqrt(values), float((centred**2).sum() / n)


def check(df, rows, k=8):
    ids, n, deviations, values, w, total = brute(rows, k)
    found = df.select(NAMES).collect()
    assert len(found) == n * len(values)
    by = {(r["vec_id"], r["component"]): r for r in found}
    assert len(by) == len(found) and {r["n"] for r in found} == {n}
    got = np.array([[by[i, c + 1]["whitened"] for c in range(len(values))] for i in ids])
    assert [by[i, 1]["deviation"] for i in ids] == deviations
    assert np.allclose([by[ids[0], c + 1]["explained"] for c in range(len(values))], values / total, rtol=1e-9)
    signs = np.sign((got * w).sum(axis=0))
    assert np.allclose(got * signs, w, rtol=1e-6, atol=1e-7)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-9


@pytest.mark.parametrize(("width", "group"), [(64, 32), (5, 2), (1, 2)])
def test_vectors(spark, monkeypatch, width, group):
    monkeypatch.setattr(whitening, "GROUP", group)
    rng = np.random.default_rng(width)
    spread = rng.standard_normal((width, width)) * 1.3 ** -np.arange(width)
    rows = [(i, (3 + v @ spread).tolist()) for i, v in enumerate(rng.standard_normal((400, width)))]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)), [(i, np.float32(v).tolist()) for i, v in rows], min(8, width))


def test_spread_far_below_the_offset(spark):
    """Variances of 10^10 down to 1, far from the origin: the mean is taken off before anything is multiplied."""
    rng = np.random.default_rng(2)
    rows = [(i, (1e6 + v * [1000, 100, 10, 1, 0.1, 0.02]).tolist()) for i, v in enumerate(rng.standard_normal((300, 6)))]
    check(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)


def test_edge_rows(spark, clashing):
    schema = "vec_id long, embedding array<double>"
    good = [(i, [float(i), float(i * i % 7), 0.25 * (i % 3)]) for i in range(40)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [math.nan, 1.0, 1.0]), (104, [1.0, math.inf, 1.0])]
    df = clashing(spark.createDataFrame(good + bad, schema), "x", "w", "n", "r", "i", "component")
    check(whitening.whiten(df), good, 3)
    again = whitening.whiten(spark.createDataFrame([*good, (None, good[0][1]), good[1]], schema)).collect()  # no id, repeated row
    assert len(again) == 3 * 42 and {r["n"] for r in again} == {42} and sum(r["vec_id"] is None for r in again) == 3
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], schema)).collect()
    assert {r["component"] for r in flat} == {1} and {round(r["explained"], 12) for r in flat} == {1.0}
    for none in ([], bad, good[:1], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(none, schema)).collect() == []


def test_equal_variances(spark):
    """Directions of one variance are orthogonal and of the right variance, whichever they are."""
    rows = [(2 * i + s, [float(s * 2 - 1) if j == i else 0.0 for j in range(10)]) for i in range(10) for s in range(2)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 160 and found[0]["identity_error"] < 1e-10 and np.allclose([r["explained"] for r in found], 0.1)


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0]), (2, [1.0])], [(1, [1e300]), (2, [1.0])]])
def test_what_cannot_be_whitened_is_refused(spark, rows):
    with pytest.raises(Exception, match="different lengths|too large"):
        whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)).collect()


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check(whitening.whiten(df), rows)
