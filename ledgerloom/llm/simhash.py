"""SimHash near-duplicates by anchor-point covering (operator 8).

A text's fingerprint has a bit set where more than half of its shingles' hashes have it set. Copies of a fingerprint
are one node. To find nodes within ``max_distance`` bits, the 64 bits are cut into blocks; two such nodes differ by at
most t = max_distance // blocks bits in one of them. The anchors of a block are the words of a covering code: a
Hamming code over its first 2^r - 1 bits, all values of the others, so each value lies within R = 1 of an anchor that
equals it in the other bits, its home. A node is copied to every anchor within R + t of its value; whoever is at home at an anchor is
compared with all that were copied there. That misses no pair: if x is at home at c, and y differs from x by t, then
y lies within R + t of c.

A bucket gives links of a spanning forest, not all pairs: a node that was reached is compared only with nodes that
were not, so a dense group costs about its size. A task holds the 8-byte nodes of one bucket.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, column, cut, free_name, map_batches, partitions, texts_of, with_ids
from ledgerloom.llm.components import components

BITS, SEED = 64, 42
#: Up to so many different fingerprints three blocks are used, beyond them two: fuller buckets against more copies.
THREE_BLOCKS = 1 << 27


def fingerprint(text: str, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint; 0 for a text without words."""
    words = text.encode("utf-8").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    common = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(common, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fingerprint of every whole text as a signed long. A null text counts as empty."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            found = np.array([fingerprint(text, shingle) for text in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return map_batches(texts_of(docs, id_col, text_col), work, "doc_id long, fp long")


class Cover:
    """Anchors of one block of the fingerprint."""

    def __init__(self, first: int, width: int, distance: int) -> None:
        self.first, self.width = first, width
        self.parity = (width + 1).bit_length() - 1
        self.coded = (1 << self.parity) - 1
        reach = distance + 1
        masks: list[list[int]] = [[] for _ in range(1 << self.parity)]
        for weight in range(min(reach, width) + 1):
            for places in combinations(range(width), weight):
                mask = sum(1 << p for p in places)
                masks[int(self.syndrome(np.array([mask], dtype=np.uint64))[0])].append(mask)
        #: By syndrome: what to flip to get to each anchor in reach.
        self.masks = [np.array(m, dtype=np.uint64) for m in masks]

    def block(self, fps: np.ndarray) -> np.ndarray:
        return (fps >> np.uint64(self.first)) & np.uint64((1 << self.width) - 1)

    def syndrome(self, values: np.ndarray) -> np.ndarray:
        """Sum of the numbers of the set bits, counted from 1; 0 for the words of the Hamming code."""
        out = np.zeros(len(values), dtype=np.int64)
        for place in range(self.coded):
            out ^= np.where((values >> np.uint64(place)) & np.uint64(1), place + 1, 0)
        return out

    def home(self, values: np.ndarray) -> np.ndarray:
        wrong = self.syndrome(values)
        return np.where(wrong > 0, values ^ (np.uint64(1) << np.maximum(wrong - 1, 0).astype(np.uint64)), values)

    def anchors(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the value, anchor) for all anchors in reach."""
        index, found = [], []
        syndromes = self.syndrome(values)
        for syndrome, masks in enumerate(self.masks):
            own = np.flatnonzero(syndromes == syndrome)
            index.append(np.repeat(own, len(masks)))
            found.append((values[own][:, None] ^ masks[None]).ravel())
        return np.concatenate(index), np.concatenate(found)


@lru_cache(maxsize=4)
def covers(blocks: int, max_distance: int) -> list[Cover]:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [Cover(a, b - a, max_distance // blocks) for a, b in zip(edges, edges[1:], strict=False)]


def spanning_links(nodes: np.ndarray, at_home: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the nodes; two nodes are neighbours if close and one of them is at home."""
    links: list[tuple[int, int]] = []
    rest = np.arange(len(nodes))
    homes = np.flatnonzero(at_home)
    for seed in homes.tolist():
        if len(rest) < 2:
            break
        if not at_home[seed]:
            continue  # reached from another
        at_home[seed] = False
        frontier = [(seed, True)]
        rest = rest[rest != seed]
        while frontier and len(rest):
            node, home = frontier.pop()
            others = rest if home else rest[at_home[rest]]
            near = others[np.bitwise_count(nodes[others] ^ nodes[node]) <= max_distance]
            if len(near):
                links += [(node, other) for other in near.tolist()]
                frontier += zip(near.tolist(), at_home[near].tolist(), strict=True)
                at_home[near] = False
                rest = np.setdiff1d(rest, near, assume_unique=True)
    return links


def links(fps: DataFrame, max_distance: int, blocks: int) -> DataFrame:
    """(a, b): links that connect the different values of column ``fp`` within ``max_distance`` bits of each other."""

    def spread(batches: Batches) -> Batches:
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for block, cover in enumerate(covers(blocks, max_distance)):
                own = cover.block(values)
                index, anchors = cover.anchors(own)
                home = cover.home(own)[index] == anchors
                key = anchors.astype(np.int64) * blocks + block
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(values[index].view(np.int64)), pa.array(home)], ["anchor", "fp", "home"])

    def compare(batches: Batches) -> Batches:
        key, held = None, []
        for batch in batches:
            anchors = batch.column("anchor").to_numpy()
            fps, home = batch.column("fp").to_numpy().view(np.uint64), batch.column("home").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(anchors)) + 1).tolist(), len(anchors)]
            out: list[np.ndarray] = []
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if key is not None and anchors[a] != key:
                    out += bucket(held)
                    held = []
                key = anchors[a]
                held.append((fps[a:b], home[a:b]))
            yield pairs(out)
        yield pairs(bucket(held))

    def bucket(held: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        if sum(len(nodes) for nodes, _ in held) < 2:
            return []
        nodes, home = (held[0][0], held[0][1].copy()) if len(held) == 1 else (np.concatenate([h[i] for h in held]) for i in (0, 1))
        found = spanning_links(nodes, home, max_distance) if home.any() else []
        return [nodes[np.array(found)]] if found else []

    def pairs(found: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, i]).view(np.int64)) for i in (0, 1)], ["a", "b"])

    n = partitions(fps.sparkSession)
    copies = map_batches(fps.select("fp"), spread, "anchor long, fp long, home boolean", rows=4096)
    return map_batches(copies.repartition(n, "anchor").sortWithinPartitions("anchor"), compare, "a long, b long", rows=4096).distinct()


def _linked(nodes: DataFrame, max_distance: int) -> DataFrame:
    """The nodes, one for each value of ``fp``, with the ``root`` of their component."""
    blocks = 3 if nodes.count() <= THREE_BLOCKS else 2
    roots = components(links(nodes, max_distance, blocks)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row; component_id is the smallest doc_id reachable.

    Texts without words have fingerprint zero and are linked like any other. Repeated rows are kept. A row without
    doc_id is linked too, but names no component; the component of such rows alone is null. Other columns are not
    read. An empty table gives no rows.
    """
    own = cut(fingerprints(docs, shingle, id_col, text_col))
    linked = _linked(cut(own.groupBy("fp").agg(F.min("doc_id").alias("first"))), max_distance)
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = linked.join(least, "root").select("fp", "component_id")
    return own.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stand for their component, one for each; rows without id are left as they are."""
    keep = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    known = with_ids(docs, id_col, keep, "left_semi").dropDuplicates([id_col])
    return known.unionByName(docs.filter(column(id_col).isNull()))


def one_of_each(docs: DataFrame, shingle: int = 4, max_distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component of near-duplicate rows: the one with the smallest id, one without id only if none has one.

    A row is known by its id and its text, so each text of a repeated id counts by itself, and copies of a row without
    id go as others do. Of one id's rows the one whose text has the smallest digest stays. Null texts count as empty.
    """
    def keyed(texts: Batches) -> Batches:
        for batch in texts:
            found = np.array([fingerprint(text, shingle) for text in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(found.view(np.int64))], ["doc_id", "digest", "fp"])

    own = texts_of(docs, id_col, text_col)
    own = map_batches(own.withColumn("digest", F.sha2("text", 256)), keyed, "doc_id long, digest string, fp long")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("first")
    linked = _linked(cut(own.groupBy("fp").agg(first)), max_distance)
    keep = cut(linked.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.digest"))
    id_, digest = free_name(docs, "id_"), free_name(docs, "digest")
    keep = keep.toDF(id_, f"{digest}_kept")
    marked = docs.withColumn(digest, F.sha2(F.coalesce(column(text_col).cast("string"), F.lit("")), 256))
    same = column(id_col).cast("long").eqNullSafe(F.col(id_)) & (F.col(digest) == F.col(f"{digest}_kept"))
    return marked.join(keep, same, "left_semi").dropDuplicates([id_col, digest]).drop(digest)
