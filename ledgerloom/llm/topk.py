"""Exact top-k search by Fagin's threshold algorithm (operator 6).

Queries and candidates meet in cells: one block of candidates and one block of queries each. In a cell every dimension
has a sorted list of the candidates' values. Sorted access goes down all lists from both ends, in steps that double;
what it meets is scored in full against the queries still running. A candidate that was not met has, in every
dimension, a value between the two ends reached, which bounds its score; a query stops when that bound cannot reach
its k-th best score. Cells give k + 1 candidates a query, and the best of these are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import narrow

#: Vectors of one cell; 64 integers each make 1 MB of candidates.
CANDIDATE_BLOCK, QUERY_BLOCK = 2048, 2048
#: Entries of each list that the first step reads.
FIRST_STEP = 16


def quantized(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, as long, of the rows with an id and only finite components."""
    rows = narrow(vectors, vec_id=id_col, v=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(False)))
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long")))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with 0."""
    flat, offsets = vectors.flatten().to_numpy(), vectors.offsets.to_numpy()
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], lengths)] = flat
    return out


def threshold_search(candidates: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's index, ids, scores) of each query's k best candidates, of equal scores the smaller ids first."""
    n, width = candidates.shape
    largest = [int(np.abs(m).max(initial=0)) for m in (candidates, queries)]
    kind = np.float64 if largest[0] * largest[1] * max(1, width) < 1 << 53 else np.int64  # both exact
    candidates, queries = candidates.astype(kind), queries.astype(kind)
    order = np.argsort(candidates, axis=0, kind="stable")
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
    met = np.zeros(n, dtype=bool)
    running = np.arange(len(queries))
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, kind))] * len(queries)
    depth = 0
    while len(running):
        before, depth = depth, min(n, max(FIRST_STEP, depth * 2))
        fresh = np.zeros(n, dtype=bool)
        fresh[order[before:depth].ravel()] = True
        fresh[order[n - depth : n - before].ravel()] = True
        fresh = np.flatnonzero(fresh & ~met)
        met[fresh] = True
        left = n - np.count_nonzero(met)
        if left:
            low = candidates[order[depth - 1], np.arange(width)]
            high = candidates[order[n - depth], np.arange(width)]
            bound = positive[running] @ high + negative[running] @ low
        scores = queries[running] @ candidates[fresh].T
        going = []
        for i, q in enumerate(running.tolist()):
            own_ids, own = np.concatenate([best[q][0], ids[fresh]]), np.concatenate([best[q][1], scores[i]])
            if len(own) > k:
                enough = np.flatnonzero(own >= np.partition(own, len(own) - k)[len(own) - k])
                own_ids, own = own_ids[enough], own[enough]
            first = np.lexsort((own_ids, -own))[:k]
            best[q] = own_ids[first], own[first]
            if not left or (len(first) == k and own[first[-1]] > bound[i]):
                yield q, best[q][0], best[q][1].astype(np.int64)
            else:
                going.append(q)
        running = np.array(going, dtype=np.int64)


def _blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def _cells(name: str, own: int, others: int) -> tuple[Column, Column]:
    """Block of a row by its id, and the blocks of the other side that it meets."""
    return F.pmod(F.xxhash64("vec_id"), F.lit(own)).alias(name), F.explode(F.sequence(F.lit(0), F.lit(others - 1)))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of each query among all rows but its own.

    Equal scores go to the smaller vec_id. Rows without id, null vectors and vectors with a null or non-finite
    component take no part. Vectors of different lengths count as filled up with 0. A repeated row is a candidate of
    its own, and asks on its own. Fewer candidates than k give fewer rows; an empty table gives none. ``is_query`` is
    a condition on vec_id. Scores are exact below 2^63.
    """
    rows = quantized(vectors, id_col, vector_col)
    asked = rows.filter(is_query).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    counted = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    c_blocks, q_blocks = _blocks(counted["n"], CANDIDATE_BLOCK), _blocks(counted["q"], QUERY_BLOCK)
    block, others = _cells("c", c_blocks, q_blocks)
    left = rows.select("vec_id", "v", F.lit(0).cast("long").alias("copies"), block, others.alias("q"))
    block, others = _cells("q", q_blocks, c_blocks)
    right = asked.select("vec_id", "v", "copies", block, others.alias("c"))

    def work(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        vectors, ids, copies = (cell.column(n).combine_chunks() for n in ("v", "vec_id", "copies"))
        width = int(np.diff(vectors.offsets.to_numpy()).max(initial=0))
        matrix, ids, copies = _matrix(vectors, width), ids.to_numpy(), copies.to_numpy()
        ask = copies > 0
        asked_ids, asked_copies = ids[ask], copies[ask]
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        itself = (matrix[ask] * matrix[ask]).sum(axis=1)
        for q, found, scores in threshold_search(matrix[~ask], ids[~ask], matrix[ask], k + 1):
            for part, values in zip(out, (np.full(len(found), asked_ids[q]), np.full(len(found), asked_copies[q]), np.full(len(found), itself[q]), found, scores), strict=True):
                part.append(values)
        return pa.table([pa.array(np.concatenate(p) if p else np.zeros(0, np.int64), pa.int64()) for p in out], names=["query_id", "copies", "itself", "vec_id", "score"])

    met = left.unionByName(right).groupBy("c", "q").applyInArrow(work, "query_id long, copies long, itself long, vec_id long, score long")
    # ``itself`` tells apart queries that share an id but not a vector, as far as scores can.
    by_query = Window.partitionBy("query_id", "copies", "itself").orderBy(F.desc("score"), "vec_id")
    best = met.withColumn("place", F.row_number().over(by_query)).filter(F.col("place") <= k + 1)
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("itself"))
    first_own = F.min(F.when(own, F.col("place"))).over(Window.partitionBy("query_id", "copies", "itself"))
    others = best.withColumn("own", F.coalesce(first_own, F.lit(k + 1))).filter("place != own")
    ranked = others.withColumn("rank", F.expr("int(place - if(place > own, 1, 0))"))
    return ranked.withColumn("_", F.explode(F.expr("sequence(1L, copies)"))).select("query_id", "rank", "vec_id", "score")
