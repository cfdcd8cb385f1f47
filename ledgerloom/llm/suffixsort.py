"""Distributed sort of byte strings that passes on common prefixes instead of comparing them again.

Each task sorts its strings into runs, keeps of each string only what follows the prefix it shares with the one before
(front coding), and cuts the runs at splitters. A target's runs meet in a loser tree that knows, for each run's head,
how many bytes it shares with the last string taken: heads that share more are smaller without a look at their bytes,
and heads that share the same are compared from there on. The prefix shared with the string taken before falls out for
each string, which is what a suffix array's LCP table holds.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, partitions

#: Strings of one sorted run; of some 400 bytes each, 25 MB.
RUN = 50_000
#: Bytes that one target is meant to hold, and sampled strings for each.
TARGET_BYTES, SAMPLED = 32 << 20, 24


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of strings that share ``known`` bytes."""
    n, at = min(len(a), len(b)), known
    while at < n:
        x, y = a[at : at + 32], b[at : at + 32]
        if x != y:
            k = min(len(x), len(y))
            differ = (int.from_bytes(x[:k], "big") ^ int.from_bytes(y[:k], "big")).bit_length()
            return at + k - (differ + 7) // 8
        at += 32
    return n


Entry = tuple[int, bytes, int]  # bytes shared with the entry before, the rest, id


def front_coded(strings: list[tuple[bytes, int]]) -> list[Entry]:
    """Entries of sorted strings; of more than two equal ones with one id two are enough."""
    out: list[Entry] = []
    before, copies = (b"", None), 0
    for string, key in strings:
        copies = copies + 1 if (string, key) == before else 1
        if copies > 2:
            continue
        same = shared(before[0], string)
        out.append((same, string[same:], key))
        before = string, key
    return out


class LoserTree:
    """Merges runs of entries; iterates over (bytes shared with the string before, string, id) in order."""

    def __init__(self, runs: list[Iterator[Entry]]) -> None:
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.runs = [*runs, *[iter(())] * (self.size - len(runs))]
        self.heads: list[bytes | None] = [None] * self.size
        self.keys = [0] * self.size
        self.shares = [0] * self.size  # bytes that a head shares with the last string taken
        for i in range(self.size):
            self._advance(i, b"")
        self.losers = [0] * self.size
        self.winner = self._build(1)

    def _advance(self, i: int, before: bytes) -> None:
        entry = next(self.runs[i], None)
        if entry is None:
            self.heads[i] = None
        else:
            self.shares[i], rest, self.keys[i] = entry
            self.heads[i] = before[: entry[0]] + rest

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.losers[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser then knows what it shares with the winner."""
        x, y = self.heads[a], self.heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if self.shares[a] != self.shares[b]:
            return (a, b) if self.shares[a] > self.shares[b] else (b, a)
        same = shared(x, y, self.shares[a])
        winner, loser = (a, b) if x[same:] <= y[same:] else (b, a)
        self.shares[loser] = same
        return winner, loser

    def __iter__(self) -> Iterator[tuple[int, bytes, int]]:
        while (string := self.heads[self.winner]) is not None:
            i = self.winner
            yield self.shares[i], string, self.keys[i]
            self._advance(i, string)
            node = (i + self.size) >> 1
            while node:
                i, self.losers[node] = self._play(i, self.losers[node])
                node >>= 1
            self.winner = i


def _block(entries: list[Entry]) -> tuple[bytes, bytes, bytes, bytes]:
    return (
        np.array([e[0] for e in entries], dtype="<u4").tobytes(),
        np.array([len(e[1]) for e in entries], dtype="<u4").tobytes(),
        b"".join(e[1] for e in entries),
        np.array([e[2] for e in entries], dtype="<i8").tobytes(),
    )


def _entries(shares: bytes, sizes: bytes, rest: bytes, keys: bytes) -> Iterator[Entry]:
    at = 0
    for same, size, key in zip(np.frombuffer(shares, "<u4").tolist(), np.frombuffer(sizes, "<u4").tolist(), np.frombuffer(keys, "<i8").tolist(), strict=True):
        yield same, rest[at : at + size], key
        at += size


def longest_shared(strings: DataFrame) -> DataFrame:
    """(id, shared): for each id the most bytes its string shares, from the start, with any other row's.

    Rows are (id long, s binary) with one string for each id; a second row of an id counts as another string that is
    equal. Every id comes out once.
    """
    spark = strings.sparkSession
    counted = strings.agg(F.count("*").alias("n"), F.sum(F.length("s").cast("long")).alias("bytes")).first()
    targets = max(partitions(spark), -(-(counted["bytes"] or 0) // TARGET_BYTES))
    chance = min(1.0, targets * SAMPLED / max(1, counted["n"]))
    drawn = strings.filter(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) <= int(chance * (1 << 30))).select("s").distinct().collect()
    sample = sorted(bytes(r["s"]) for r in drawn)
    splitters = [sample[len(sample) * i // targets] for i in range(1, targets)] if sample else []

    def sort(batches: Batches) -> Batches:
        held: list[tuple[bytes, int]] = []
        for batch in batches:
            held += zip(batch.column("s").to_pylist(), batch.column("id").to_pylist(), strict=True)
            if len(held) >= RUN:
                yield run(held)
                held = []
        yield run(held)

    def run(held: list[tuple[bytes, int]]) -> pa.RecordBatch:
        held.sort()
        parts: dict[int, list[tuple[bytes, int]]] = {}
        for string, key in held:
            parts.setdefault(bisect_right(splitters, string), []).append((string, key))
        rows = [(target, *_block(front_coded(part))) for target, part in parts.items()]
        columns = [pa.array([r[i] for r in rows], pa.int64() if i == 0 else pa.binary()) for i in range(5)]
        return pa.RecordBatch.from_arrays(columns, ["target", "shares", "sizes", "rest", "keys"])

    def combine(blocks: pa.Table) -> pa.Table:
        runs = [_entries(*row) for row in zip(*(blocks.column(n).to_pylist() for n in ("shares", "sizes", "rest", "keys")), strict=True)]
        ids, best, last = [], [], b""
        first: bytes | None = None
        for same, string, key in LoserTree(runs):
            if first is None:
                first, same = string, 0
            elif best[-1] < same:
                best[-1] = same
            ids.append(key)
            best.append(same)
            last = string
        edges = [first, *[None] * (len(ids) - 1)], [*[None] * (len(ids) - 1), last]
        target = blocks.column("target")[0].as_py()
        return pa.table([pa.array([target] * len(ids)), pa.array(ids, pa.int64()), pa.array(best, pa.int64()), pa.array(edges[0], pa.binary()), pa.array(edges[1], pa.binary())], names=["target", "id", "shared", "first", "last"])

    runs = map_batches(strings.select("id", "s"), sort, "target long, shares binary, sizes binary, rest binary, keys binary", rows=4096)
    found = cut(runs.groupBy("target").applyInArrow(lambda blocks: combine(blocks), "target long, id long, shared long, first binary, last binary"), "lcp")
    # Neighbours across two targets: two strings for each target.
    edges = found.filter("first IS NOT NULL OR last IS NOT NULL").select("target", "id", "first", "last").collect()
    firsts = {r["target"]: r for r in edges if r["first"] is not None}
    lasts = {r["target"]: r for r in edges if r["last"] is not None}
    across, order = [], sorted(firsts)
    for a, b in zip(order, order[1:], strict=False):
        same = shared(bytes(lasts[a]["last"]), bytes(firsts[b]["first"]))
        across += [(lasts[a]["id"], same), (firsts[b]["id"], same)]
    found = found.select("id", "shared").unionByName(spark.createDataFrame(across, "id long, shared long"))
    return cut(found.groupBy("id").agg(F.max("shared").alias("shared")), "shared")
