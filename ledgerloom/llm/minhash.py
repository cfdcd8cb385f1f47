"""MinHash near-duplicates by fast similarity sketching (operator 12).

A document is its set of different word shingles. Its sketch has T coordinates. In round i each shingle falls into a bin
by a hash and brings the value i plus a second hash below 1; a bin keeps the least value it has got. Sketching ends with
the round after which no bin is empty. Rounds up to T throw all shingles into all bins; each round from T on throws them
into one bin only, so the last bin is filled by round 2 T at the latest. Two sets agree in a coordinate with the chance
of their similarity, and the number of coordinates that agree is concentrated as if they were independent.

Equal sets are one class. Classes that agree in all rows of a band share a bucket. Candidates are confirmed on the full
sets, and only pairs of classes not known to be connected are compared:

1. one class of a bucket with all others of it: the first one, then the one with most links so far;
2. what is then still apart within a bucket, in blocks of bounded size, which give a spanning forest of the links.

At similarity 0.85 a pair meets in none of the BANDS bands with a chance of 2e-9.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, partitions, texts_of
from ledgerloom.llm.components import components

T, ROWS = 256, 6
BANDS = T // ROWS
#: Classes and shingles that one block of a bucket is meant to hold; a shingle takes 8 bytes.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20

_GOLDEN, _C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_VALUE = 54
_LOW = np.uint64((1 << _VALUE) - 1)
_EMPTY = np.uint64((1 << 64) - 1)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _C1
    z = (z ^ (z >> np.uint64(27))) * _C2
    return z ^ (z >> np.uint64(31))


def shingles(text: str, size: int = 3) -> tuple[int, np.ndarray]:
    """(number of different shingles, their sorted 64-bit hashes); the whole sequence if there are fewer words, none without words."""
    words = text.encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0, np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        different = {joined}
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        different = {joined[a:b] for a, b in zip(starts[: 1 - size].tolist(), ends[size - 1 :].tolist(), strict=True)}
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, different), np.uint64, len(different))
    return len(different), np.unique(hashes)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """T coordinates of a set that is not empty: the round of each in the upper bits, the second hash in the lower ones."""
    out = np.full(T, _EMPTY)
    done, step = 0, 1
    while done < T:
        rounds = np.arange(done, min(T, done + step), dtype=np.uint64)[:, None]
        z = _mixed(hashes[None] + (rounds + np.uint64(1)) * _GOLDEN)
        np.minimum.at(out, (z >> np.uint64(56)).ravel(), ((rounds << np.uint64(_VALUE)) | (z & _LOW)).ravel())
        done += len(rounds)
        if (out != _EMPTY).all():
            return out
        step = max(1, min(T, 4096 // len(hashes)))
    for place in np.flatnonzero(out == _EMPTY).tolist():
        own = np.array([T + place], dtype=np.uint64)
        out[place] = ((own << np.uint64(_VALUE)) | (_mixed(hashes + (own + np.uint64(1)) * _GOLDEN) & _LOW).min())[0]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each sketch."""
    rows = sketches[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    for row in range(ROWS):
        keys = _mixed((keys + _GOLDEN) ^ rows[:, :, row])
    return keys


def _sketched(docs: DataFrame, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The texts with the key (k, h) of their rows, and (doc_id, k, h, c1, c2, n, keys) of each row."""
    texts = texts_of(docs, id_col, text_col)
    texts = texts.select("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h"), "text")
    long = pa.int64()

    def work(batches: Batches) -> Batches:
        for batch in batches:
            n, digests, sketches = [], [], []
            for text in batch.column("text").to_pylist():
                count, hashes = shingles(text, size)
                n.append(count)
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                sketches.append(sketch(hashes) if count else np.zeros(T, dtype=np.uint64))
            both = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            all_ = np.array(sketches, dtype=np.uint64).reshape(-1, T)
            keys = pa.FixedSizeListArray.from_arrays(pa.array(band_keys(all_).view(np.int64).ravel()), BANDS).cast(pa.list_(long))
            columns = [*(batch.column(c) for c in ("doc_id", "k", "h")), *(pa.array(np.ascontiguousarray(both[:, i])) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, long), keys], ["doc_id", "k", "h", "c1", "c2", "n", "keys"])

    schema = "doc_id long, k long, h long, c1 long, c2 long, n long, keys array<long>"
    return texts, cut(map_batches(texts, work, schema), "sketches")


def _sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(c, hashes): the full set of each wanted class (c, k, h), as the sorted hashes of its shingles."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            sets = [shingles(text, size)[1].tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("c"), pa.array(sets, pa.binary())], ["c", "hashes"])

    found = map_batches(texts.select("k", "h", "text").join(wanted, ["k", "h"]).select("c", "text"), work, "c long, hashes binary")
    return cut(found.dropDuplicates(["c"]), "sets")  # a repeated row gives its set again


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose full sets are similar enough."""

    def work(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = np.sort(np.concatenate([x, y]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wide = pairs.join(sets.toDF("b", "y"), "b").join(sets.toDF("a", "x"), "a")
    return map_batches(wide.select("a", "b", "x", "y"), work, "a long, b long")


def spanning_links(sets: list[np.ndarray], sizes: np.ndarray, labels: np.ndarray, first: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets that join different labels, so many as connect what can be connected.

    Sets are arrays of distinct hashes. If ``first`` is mixed, only sets of the two kinds are compared with each other. A
    hash that one set alone has cannot be shared, and what a set has left bounds its similarity to all others; where
    that bound allows a link, the shared hashes are counted.
    """
    flat, ids = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count[token] > 1
    token, ids = token[common], ids[common]
    left = np.bincount(ids, minlength=len(sets))
    edges = np.concatenate([[0], np.cumsum(left)])
    mark, labels, links, mixed = np.zeros(len(count), dtype=np.int64), labels.copy(), [], not first.all()
    for i in range(len(sets)):
        others = labels != labels[i]
        others = np.flatnonzero(others & ~first) if mixed and first[i] else np.zeros(0, np.int64) if mixed else i + 1 + np.flatnonzero(others[i + 1 :])
        most = np.minimum(left[others], left[i])
        others = others[100 * most >= percent * (sizes[others] + sizes[i] - most)]
        if not len(others):
            continue
        mark[token[edges[i] : edges[i + 1]]] = 1
        lengths = left[others]
        starts = np.cumsum(lengths) - lengths
        places = np.arange(int(lengths.sum())) + np.repeat(edges[others] - starts, lengths)
        shared = np.add.reduceat(mark[token[places]], starts)
        mark[token[edges[i] : edges[i + 1]]] = 0
        for j in others[100 * shared >= percent * (sizes[others] + sizes[i] - shared)].tolist():
            if labels[j] != labels[i]:
                links.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return links


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components that still share a bucket, from members (key, c, label, blocks) and the full sets."""

    def work(batches: Batches) -> Batches:
        key, held = None, []
        for batch in batches:
            for *own, first, c, label, hashes in zip(*(batch.column(x).to_pylist() for x in ("key", "low", "high", "first", "c", "label", "hashes")), strict=True):
                if own != key:
                    yield block(held)
                    key, held = own, []
                held.append((first, c, label, np.frombuffer(hashes, dtype=np.uint64)))
        yield block(held)

    def block(held: list[tuple]) -> pa.RecordBatch:
        both = np.zeros((0, 2), dtype=np.int64)
        if len(held) > 1:
            first, c, label = (np.array([r[i] for r in held]) for i in range(3))
            sets = [r[3] for r in held]
            links = spanning_links(sets, np.array([len(s) for s in sets]), label, first, percent)
            both = c[np.array(links, dtype=np.int64).reshape(-1, 2)]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, i]), pa.int64()) for i in (0, 1)], ["a", "b"])

    # Each class goes to its own block with every other one of its bucket; "first" tells the two blocks of a pair apart.
    blocks = members.join(sets, "c").withColumn("own", F.pmod(F.xxhash64("c"), "blocks").cast("int"))
    blocks = blocks.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("other"))
    blocks = blocks.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") <= F.col("other")).alias("first"), "c", "label", "hashes")
    key = ["key", "low", "high"]
    return map_batches(blocks.repartition(partitions(blocks.sparkSession), *key).sortWithinPartitions(*key), work, "a long, b long")


def _labelled(members: DataFrame, links: DataFrame | None) -> DataFrame:
    """Members (key, c, n) with the ``label`` of their component and the number of their ``links`` so far; buckets of one component go."""
    if links is None:
        members = members.withColumns({"label": F.col("c"), "links": F.lit(0).cast("long")})
    else:
        roots = components(links).toDF("c", "root")
        degree = links.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count("*").alias("links"))
        members = members.join(roots.join(degree, "c", "left"), "c", "left")
        members = members.select("key", "c", "n", F.coalesce("root", "c").alias("label"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    apart = members.groupBy("key").agg(
        F.min("label").alias("l0"), F.max("label").alias("l1"), F.count("*").alias("size"), F.sum("n").alias("shingles"),
        F.max(F.struct("links", (-F.col("c")).alias("c"), "n", "label")).alias("lead"),
        F.sum(F.xxhash64("c").cast("decimal(38,0)")).alias("s0"), F.sum(F.xxhash64("c", F.lit(1)).cast("decimal(38,0)")).alias("s1"),
    ).filter("l0 < l1")
    # Of buckets with the same members one is enough.
    apart = cut(apart.groupBy("size", "s0", "s1").agg(F.min(F.struct("key", "lead")).alias("one"), F.max("shingles").alias("shingles")).select("one.*", "size", "shingles"), "apart")
    return cut(members.join(apart, "key"), "members")


def _components(classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(c, root) of the classes (c, k, h, n, keys) that have a link."""
    rows = classes.select("c", "n", F.explode("keys").alias("key"))
    shared = cut(rows.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 < c1").select("key"), "buckets")
    members = cut(rows.join(shared, "key"), "members")
    wanted = members.select("c").distinct()
    sets = _sets(texts, classes.select("c", "k", "h").join(wanted, "c"), size)
    links = None
    for _ in ("first", "most linked"):
        now = _labelled(members, links)
        lead, close = -F.col("lead.c"), 100 * F.least("n", "lead.n") >= percent * F.greatest("n", "lead.n")
        pairs = now.filter((F.col("label") != F.col("lead.label")) & close).select(F.least("c", lead).alias("a"), F.greatest("c", lead).alias("b")).distinct()
        found = cut(confirmed(pairs, sets, percent), "links")
        links = found if links is None else links.unionByName(found)
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    rest = cut(_rest(_labelled(members, links).withColumn("blocks", blocks), sets, percent), "links")
    return components(links.unionByName(rest)).toDF("c", "root")


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row for each row; component_id is the smallest doc_id reachable.

    Rows are linked if 100 * shared shingles >= percent * all shingles of the two. A document without words has no
    shingles and is linked with nothing; its component is its own id. Repeated rows are kept. A row without doc_id is
    linked too but names no component and is not ``kept``; the component of such rows alone is null. A null text counts
    as empty. Other columns are not read. An empty table gives no rows.
    """
    texts, own = _sketched(docs, size, id_col, text_col)
    classes = own.filter("n > 0").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("first"), F.min(F.struct("k", "h")).alias("row"), *[F.first(c).alias(c) for c in ("n", "keys")]
    )  # rows of a class differ in id and text only
    # The number of a class is fixed once it is written.
    classes = cut(classes.select(F.monotonically_increasing_id().alias("c"), "c1", "c2", "first", "row.*", "n", "keys"), "classes")
    roots = _components(classes, texts, size, percent)
    linked = classes.select("c", "c1", "c2", "first").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(least, "root").select("c1", "c2", "least")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")
    out = own.select("doc_id", "c1", "c2", "n").join(linked, ["c1", "c2"], "left").select("doc_id", F.col("n").alias("n_shingles"), component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
