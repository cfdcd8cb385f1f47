"""Singular values and right singular vectors by bidiagonalisation, dqds and twisted factorisations.

Small matrices only: a QR factorisation has reduced all rows to a square one before.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = np.finfo(np.float64).eps


def bidiagonalised(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, e, v): U' A V has diagonal d and superdiagonal e, with V orthogonal; Householder reflections from both sides."""
    a, n = np.array(a, dtype=np.float64), a.shape[1]
    v = np.eye(n)
    for k in range(n):
        w, beta = _reflection(a[k:, k])
        a[k:, k:] -= np.outer(beta * w, w @ a[k:, k:])
        if k + 2 < n:
            w, beta = _reflection(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, beta * w)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, beta * w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def _reflection(x: np.ndarray) -> tuple[np.ndarray, float]:
    """(w, beta): I - beta w w' maps x to a multiple of the first unit vector."""
    scale = float(np.abs(x).max(initial=0.0))
    if scale == 0.0 or not np.abs(x[1:]).max(initial=0.0):
        return np.zeros(len(x)), 0.0
    w = x / scale
    w[0] += math.copysign(float(np.linalg.norm(w)), w[0])
    return w, 2.0 / float(w @ w)


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd step with a shift; None if the shift exceeds the least eigenvalue. Adds and divides positive numbers only."""
    d, low, q2, e2 = q[0] - shift, math.inf, [], []
    for i in range(len(e)):
        if d < 0.0:
            return None
        low = min(low, d)
        q2.append(d + e[i])
        ratio = q[i + 1] / q2[i] if q2[i] else 0.0
        e2.append(e[i] * ratio)
        d = d * ratio - shift if q2[i] else -shift
    if d < 0.0:
        return None
    q2.append(d)
    return q2, e2, min(low, d)


def squared_singular_values(d: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix to high relative accuracy, falling."""
    found: list[float] = []
    work = [((d * d).tolist(), (e * e).tolist(), 0.0)]
    while work:
        q, off, sigma = work.pop()
        low, steps = 0.0, 0
        while True:
            n = len(q)
            if n == 1:
                found.append(q[0] + sigma)
                break
            # Split where the coupling no longer counts beside its neighbours and the sum of shifts.
            at = next((i for i in range(n - 1) if off[i] <= (_EPS / 4) ** 2 * max(q[i], sigma) or off[i] <= _EPS * _EPS * (sigma + min(q[i], q[i + 1]))), None)
            if at is not None:
                work.append((q[: at + 1], off[:at], sigma))
                q, off, low = q[at + 1 :], off[at + 1 :], 0.0
                continue
            if steps % 2 == 0 and q[0] < q[-1]:
                q, off = q[::-1], off[::-1]  # rows and columns in reverse order; small values come out at the end
            shift = 0.0 if steps == 0 else _shift(q, off, low)
            stepped = _dqds(q, off, shift)
            while stepped is None:
                shift = shift / 4 if shift > sigma * _EPS and shift > 0.0 and shift / 4 > 0.0 else 0.0
                stepped = _dqds(q, off, shift)
            q, off, low = stepped
            sigma += shift
            steps += 1
            if steps > 60 * n + 200:
                raise ArithmeticError("dqds does not converge")
    return np.sort(np.array(found))[::-1]


def _shift(q: list[float], e: list[float], low: float) -> float:
    """A lower bound, close near the end, of the least eigenvalue: from the last 2 by 2 block or from the last step."""
    a, b, c = q[-2], e[-1], q[-1]
    half = (a + b + c) / 2
    root = math.sqrt(max(0.0, half * half - a * c))
    least = a * c / (half + root) if half + root else 0.0  # of the block [[a + e, .], [., c]]; an upper bound
    return max(0.0, min(low, least - math.sqrt(b * c) if c > b else least / 4))


def _twisted(d: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """Eigenvector of B'B, B bidiagonal with d and e, for a value close to an eigenvalue.

    Stationary and progressive qd transforms with the value as shift, L D L' and U D U', meet at the place where the
    pivot of the twisted factorisation is least; the vector solves N D N' z = gamma e_r from there to both ends. They
    work on B itself, so vectors of small values are as good as those of large ones.
    """
    n = len(d)
    tiny = np.finfo(np.float64).tiny / _EPS
    q, off, coupling = (d * d).tolist(), (d[:-1] * e).tolist(), (e * e).tolist()
    stationary, down = [-value], []
    for i in range(n - 1):
        down.append(q[i] + stationary[i] or tiny)
        stationary.append(stationary[i] * (coupling[i] / down[i]) - value)
    progressive, up = [q[-1] - value], []
    for i in range(n - 2, -1, -1):
        up.append(coupling[i] + progressive[-1] or tiny)
        progressive.append(progressive[-1] * (q[i] / up[-1]) - value)
    progressive.reverse()
    up.reverse()
    r = int(np.argmin(np.abs(np.array(stationary) + np.array(progressive) + value)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -off[i] / down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -off[i] / up[i] * z[i]
    return z / np.linalg.norm(z)


def leading_right_vectors(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(s, v): the k largest squared singular values of ``a``, falling, and their right singular vectors as columns.

    Vectors of a cluster, values whose difference twisted factorisations cannot tell apart, are taken as a whole: they
    are made orthogonal, and within the space they span the matrix is solved anew.
    """
    scale = float(np.abs(a).max(initial=0.0))
    n = a.shape[1]
    if scale == 0.0 or not n:
        return np.zeros(min(k, n)), np.eye(n)[:, :k]
    a = np.concatenate([a, np.zeros((max(0, n - len(a)), n))]) / scale  # so that no square overflows or vanishes
    d, e, v = bidiagonalised(a)
    values = squared_singular_values(d, e)
    z = np.array([_twisted(d, e, value) for value in values.tolist()]).T
    at = 0
    while at < min(k, n):
        end = at + 1
        while end < n and values[end - 1] - values[end] <= 1e-3 * values[at]:
            end += 1
        if end - at > 1:
            z[:, at:end] = _separated(d, e, z[:, :at], z[:, at:end])
        at = end
    return values[:k] * scale**2, v @ z[:, :k]


def _separated(d: np.ndarray, e: np.ndarray, before: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    """Orthonormal vectors of a cluster, by inverse iteration on the space that its vectors span, in the order of their values."""
    b = np.diag(d) + np.diag(e, 1)
    matrix = b.T @ b
    width, n = cluster.shape[1], len(d)
    basis = cluster + 1e-3 * np.random.default_rng(0).standard_normal((n, width)) / math.sqrt(n)
    middle = float(np.mean(np.einsum("ij,ij->j", cluster, matrix @ cluster)))
    shifted = matrix - (middle + 4 * _EPS * float(np.diagonal(matrix).max())) * np.eye(n)
    for _ in range(6):
        basis -= before @ (before.T @ basis)
        basis = np.linalg.solve(shifted, np.linalg.qr(basis)[0])
    basis -= before @ (before.T @ basis)
    basis = np.linalg.qr(basis)[0]
    small = b @ basis
    return basis @ np.linalg.svd(small)[2].T
