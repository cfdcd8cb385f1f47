"""Embedding whitening (operator 13).

Each task centres its vectors and reduces them to a triangle by QR factorisations, and triangles are reduced together in
groups until one is left, so no covariance matrix is ever formed. The driver bidiagonalises that triangle, finds its
singular values by dqds and the directions by twisted factorisations (``qd``). A last pass projects the vectors.

Vectors are integers, so sums and deviations are exact. The mean, known exactly as a fraction, is taken off before
anything is multiplied; an offset far above the spread costs no digits.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, narrow
from ledgerloom.llm.qd import leading_right_vectors

SCALE, OFFSET, COMPONENTS = 1024, 100_000, 8
#: Rows of a batch; of 64 integers each, 2 MB.
BATCH = 4096
#: Triangles that are reduced in one task.
GROUP = 32


class Fit(NamedTuple):
    """What the whole table needs to be whitened: number of vectors, sums per dimension, directions as columns, their variances, the total variance."""

    n: int
    sums: list[int]
    directions: np.ndarray
    variances: np.ndarray
    total: float


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(SCALE * c) + OFFSET of every entry as long, of the rows whose vector has entries, all of them finite."""
    rows = narrow(vectors, vec_id=id_col, x=vector_col).withColumn("x", F.col("x").cast("array<double>"))
    rows = rows.filter("x IS NOT NULL AND size(x) > 0 AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))")
    scaled = F.transform("x", lambda c: c * SCALE)
    largest = F.array_max(F.transform(scaled, F.abs))
    # Beyond 2^52 doubles do not hold all integers any more.
    checked = F.when(largest < 2.0**52, scaled).otherwise(F.raise_error(F.lit("an entry is too large to be whitened exactly")).cast("array<double>"))
    return rows.withColumn("x", F.transform(checked, lambda c: F.floor(c).cast("long") + OFFSET))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    sizes = np.diff(vectors.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors of different lengths cannot be whitened together")
    return vectors.flatten().to_numpy().reshape(len(sizes), -1)


def sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and their exact sum in each dimension; one row for each dimension reaches the driver."""

    def add(batches: Batches) -> Batches:
        total, n = None, 0
        for batch in batches:
            x = _matrix(batch.column("x"))
            if not len(x):
                continue
            # High and low halves apart, so that no sum of a batch overflows.
            own = [(int(a) << 26) + int(b) for a, b in zip((x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist(), strict=True)]
            if total is not None and len(own) != len(total):
                raise ValueError("vectors of different lengths cannot be whitened together")
            total, n = own if total is None else [a + b for a, b in zip(total, own, strict=True)], n + len(x)
        if total is not None:
            rows = [pa.array(range(len(total)), pa.int64()), pa.array([str(t) for t in total]), pa.array([n] * len(total), pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, ["i", "s", "n"])

    parts = map_batches(vectors.select("x"), add, "i long, s string, n long", rows=BATCH)
    found = sorted(parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect())
    if len({r["n"] for r in found}) > 1:
        raise ValueError("vectors of different lengths cannot be whitened together")
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [])


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - sums / n, each entry rounded once or twice: whole part and remainder of the mean apart."""
    whole, rest = np.array([t // n for t in total], dtype=np.int64), np.array([t % n / n for t in total])
    return (x - whole).astype(np.float64) - rest


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def triangle(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """R of a QR factorisation of all centred vectors, reduced in tasks and then in groups of tasks."""
    width = len(total)

    def reduce_rows(batches: Batches) -> Batches:
        held = np.zeros((0, width))
        for batch in batches:
            held = _triangle(np.concatenate([held, _centred(_matrix(batch.column("x")), n, total)]))
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["r"])

    def reduce_group(blocks: pa.Table) -> pa.Table:
        parts = (np.frombuffer(r, dtype=np.float64).reshape(-1, width) for r in blocks.column("r").to_pylist())
        return pa.table([pa.array([reduce(lambda a, b: _triangle(np.concatenate([a, b])), parts).tobytes()], pa.binary())], names=["r"])

    parts = cut(map_batches(vectors.select("x"), reduce_rows, "r binary", rows=BATCH), "triangles")
    while (count := parts.count()) > 1:
        groups = -(-count // GROUP)
        place = F.pmod(F.xxhash64("r"), F.lit(groups)).alias("place")
        parts = cut(parts.select(place, "r").groupBy("place").applyInArrow(reduce_group, "r binary"), "triangles")
    return np.frombuffer(parts.first()["r"], dtype=np.float64).reshape(-1, width)  # width x width numbers


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Fit:
    """Directions and variances of what :func:`quantized` returns. Directions without variance are left out."""
    n, total = sums(vectors)
    if not n:
        return Fit(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    r = triangle(vectors, n, total)
    squares, directions = leading_right_vectors(r, components)
    # What rounding alone leaves of a direction without spread.
    real = squares > (16 * len(total) * np.finfo(np.float64).eps) ** 2 * squares.max(initial=0.0)
    return Fit(n, total, directions[:, real], squares[real] / n, float((r * r).sum() / n))


def projected(vectors: DataFrame, model: Fit) -> DataFrame:
    """(vec_id, deviation, w): exact deviation as decimal(38,0) and whitened coordinates of each vector."""
    n, total = model.n, model.sums
    scaled = model.directions / np.sqrt(model.variances)

    def work(batches: Batches) -> Batches:
        for batch in batches:
            x = _matrix(batch.column("x"))
            if not len(x):
                continue
            w = _centred(x, n, total) @ scaled
            far = max(abs(n * c - t) for edge in (x.min(axis=0), x.max(axis=0)) for c, t in zip(edge.tolist(), total, strict=True))
            kind = np.int64 if far * far * len(total) < 1 << 62 else object
            off = x.astype(kind) * n - np.array(total, dtype=kind)
            deviation = pa.array([str(d) for d in (off * off).sum(axis=1).tolist()])
            rows = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], pa.array(w.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, rows], ["vec_id", "deviation", "w"])

    found = map_batches(vectors, work, f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, deviation string, w array<double>", rows=BATCH)
    return found.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity; one grouping, merged from running means."""
    w = [F.col("w")[i] for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    row = whitened.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each remaining vector and component.

    Vectors that are null, empty, or hold a null or non-finite entry are dropped. Rows with a null or repeated vec_id
    count as vectors of their own. Components are numbered from 1 by falling variance; directions of equal variance come
    in any order and rotation, the same for all rows. A direction without variance has no component, so equal vectors,
    or a single one, give no rows, like an empty table. Vectors of different lengths, entries of 2^52 / SCALE or more,
    and deviations beyond a long raise an error. Other columns are not read.
    """
    vectors = quantized(embeddings, id_col, vector_col)
    model = fit(vectors, components)
    k, spark = len(model.variances), embeddings.sparkSession
    columns = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return spark.createDataFrame([], f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, {columns}")
    rows = cut(projected(vectors, model), "whitened")
    error = identity_error(rows, k)
    explained = F.array(*[F.lit(float(e / model.total)) for e in model.variances])
    rows = rows.select("vec_id", F.col("deviation").cast("long").alias("deviation"), F.posexplode("w").alias("i", "whitened"))
    return rows.select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"),
    )
