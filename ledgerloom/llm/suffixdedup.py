"""Removal of long repeated byte strings by a sparse suffix array (operator 3).

A string of LENGTH bytes that starts at two places is removed at both. Sorting all suffixes would move every byte of
the input hundreds of times, so the sort works on a sparse set that misses no repeat:

1. Each window of LENGTH bytes has an anchor: of its first SPAN starts the one whose next GRAM bytes hash lowest. Equal
   windows have their anchors at the same place, so a repeated window's anchor has a key (the LENGTH - SPAN + 1 bytes
   from it, which every window of the anchor holds) that occurs again. Anchors whose key is unique are done.
2. Anchors with the same bytes all around (whatever any of their windows holds) form a class. If a class has several
   members, all their windows are repeated. Classes that share no key with another class are done.
3. The suffixes from the remaining classes' anchors, and the reversed texts before them, go through the distributed
   sort of ``suffixsort``. Its common prefixes tell how far to the right and to the left a class agrees with any other
   one, which leaves the windows between the two as candidates.
4. A candidate window is repeated if its bytes occur in a second class.

Keys and windows meet through grouped counts and equi-joins, so a passage in a third of all documents is counted by
partial aggregation and split by adaptive execution; nothing gathers a group. Every step is written to the shared
folder before the next one starts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, texts_of
from ledgerloom.llm.suffixsort import longest_shared

LENGTH, SPAN, GRAM = 400, 300, 16
#: Windows of a long text that are worked on at once.
SEGMENT = 1 << 22

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 24) - 1)


def _lowest(raw: np.ndarray, span: int, windows: int) -> np.ndarray:
    """Anchor of each of the first ``windows`` windows: the leftmost start with the lowest hash among ``span``."""
    starts = windows + span - 1
    v = raw[: starts + GRAM - 1].astype(np.uint64)
    for bits in (8, 16, 32):
        n = bits // 8
        v = v[:-n] | (v[n:] << np.uint64(bits))
    h = v[:-8] * _M1 + (v[8:] ^ (v[:-8] >> np.uint64(29))) * _M2
    h ^= h >> np.uint64(32)
    h *= _M1
    blocks = -(-starts // span)
    keyed = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    keyed[:starts] = (h[:starts] & ~_PLACE) | np.arange(starts, dtype=np.uint64)
    keyed = keyed.reshape(blocks, span)
    to_right = np.minimum.accumulate(keyed, axis=1).ravel()
    to_left = np.minimum.accumulate(keyed[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(to_left[:windows], to_right[span - 1 : span - 1 + windows])
    return (lowest & _PLACE).astype(np.int64)


def anchors(raw: bytes, length: int = LENGTH, span: int = SPAN) -> np.ndarray:
    """(anchor, first window, last window) of each anchor, in order; none for texts shorter than ``length``."""
    windows, found, data = len(raw) - length + 1, [], np.frombuffer(raw, dtype=np.uint8)
    for low in range(0, max(0, windows), SEGMENT):
        n = min(SEGMENT, windows - low)
        at = _lowest(data[low:], span, n) + low
        edges = np.flatnonzero(np.diff(at))
        first = np.concatenate([[0], edges + 1])
        found.append(np.stack([at[first], first + low, np.concatenate([edges, [n - 1]]) + low], axis=1))
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    out = np.concatenate(found)
    again = np.flatnonzero((out[1:, 0] == out[:-1, 0]))  # an anchor whose windows two segments share
    out[again, 2] = out[again + 1, 2]
    return np.delete(out, again + 1, axis=0)


# A place packs the anchor with the distances to its first and last window (each below 2^10).
def _packed(found: np.ndarray) -> np.ndarray:
    return (found[:, 0] << 20) | ((found[:, 0] - found[:, 1]) << 10) | (found[:, 0] - found[:, 2])


def _unpacked() -> tuple[Column, Column, Column]:
    return F.expr("shiftright(place, 20)"), F.expr("shiftright(place, 10) & 1023"), F.expr("place & 1023")


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k, h, doc_id, text): rows of one id and text share the key (k, h)."""
    own = texts_of(docs, id_col, text_col)
    return own.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("h"), "doc_id", "text")


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def _anchor_rows(texts: DataFrame, length: int, span: int) -> DataFrame:
    """(f, s, k, h, place): key and surroundings of each anchor, as hashes."""
    digest = xxhash.xxh3_64_intdigest

    def work(batches: Batches) -> Batches:
        for batch in batches:
            f, s, k, h, place = [], [], [], [], []
            for own_k, own_h, text in zip(*(batch.column(n).to_pylist() for n in ("k", "h", "text")), strict=True):
                raw = text.encode()
                found = anchors(raw, length, span)
                for m in found[:, 0].tolist():
                    left = min(m, span - 1)
                    f.append(digest(raw[m : m + length - span + 1]))
                    s.append(digest(raw[m - left : m + length], left))
                k += [own_k] * len(found)
                h += [own_h] * len(found)
                place.append(_packed(found))
            places = pa.array(np.concatenate(place)) if place else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([_signed(f), _signed(s), pa.array(k, pa.int64()), pa.array(h, pa.int64()), places], ["f", "s", "k", "h", "place"])

    return map_batches(texts.select("k", "h", "text"), work, "f long, s long, k long, h long, place long")


def _surroundings(texts: DataFrame, classes: DataFrame, length: int, span: int) -> DataFrame:
    """(f, s, place, r, l, rights, lefts) of each class: the bytes from its anchor on, the reversed bytes before it, and their hashes."""
    digest = xxhash.xxh3_64_intdigest
    wanted = classes.groupBy("k", "h").agg(F.collect_list(F.struct("f", "s", "place")).alias("wanted"))  # bounded by the text
    joined = texts.select("k", "h", "text").join(wanted, ["k", "h"])

    def work(batches: Batches) -> Batches:
        seen = set()  # of repeated rows each task takes one; the others would give the same again
        for batch in batches:
            rows = []
            for k, h, text, classes_of in zip(*(batch.column(n).to_pylist() for n in ("k", "h", "text", "wanted")), strict=True):
                if (k, h) in seen:
                    continue
                seen.add((k, h))
                raw = text.encode()
                for c in classes_of:
                    m = c["place"] >> 20
                    right, left = raw[m : m + length], raw[max(0, m - span + 1) : m][::-1]
                    rows.append((c["f"], c["s"], c["place"], right, left))
            ids = [_signed([digest(r[i]) for r in rows]) for i in (3, 4)]
            plain = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            both = [pa.array([r[i] for r in rows], pa.binary()) for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([*plain, *ids, *both], ["f", "s", "place", "r", "l", "rights", "lefts"])

    return map_batches(joined.select("k", "h", "text", "wanted"), work, "f long, s long, place long, r long, l long, rights binary, lefts binary")


def _windows(candidates: DataFrame, length: int) -> DataFrame:
    """(f, s, d, w): hash of each candidate window, d bytes before the anchor."""
    digest = xxhash.xxh3_64_intdigest

    def work(batches: Batches) -> Batches:
        for batch in batches:
            f, s, d, w = [], [], [], []
            for own_f, own_s, low, high, right, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw, m = left[::-1] + right, len(left)
                w += [digest(raw[m - x : m - x + length]) for x in range(low, high + 1)]
                d += range(low, high + 1)
                f += [own_f] * (high - low + 1)
                s += [own_s] * (high - low + 1)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()), pa.array(s, pa.int64()), pa.array(d, pa.int64()), _signed(w)], ["f", "s", "d", "w"])

    return map_batches(candidates.select("f", "s", "low", "high", "rights", "lefts"), work, "f long, s long, d long, w long")


def repeated_stretches(texts: DataFrame, length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """(k, h, start, stop): stretches of the keyed texts that together cover all repeated strings."""
    anchor, far, near = _unpacked()
    rows = _anchor_rows(texts, length, span)
    classes = cut(rows.groupBy("f", "s").agg(F.count("*").alias("n"), F.min(F.struct("k", "h", "place")).alias("one")), "classes")
    twice = classes.filter("n > 1").select("f", "s")
    whole = rows.join(twice, ["f", "s"]).select("k", "h", (anchor - far).alias("start"), (anchor - near + length).alias("stop"))
    whole = cut(whole, "whole")

    mixed = classes.groupBy("f").agg(F.count("*").alias("c"), F.min("n").alias("fewest")).filter("c > 1 AND fewest = 1").select("f")
    mixed = cut(mixed, "keys")  # as a table of its own, so that the join by f can split a hot key
    mixed = cut(classes.join(mixed, "f").select("f", "s", "n", "one.*"), "mixed")
    around = cut(_surroundings(texts, mixed, length, span), "around")
    right = longest_shared(around.select(F.col("r").alias("id"), F.col("rights").alias("s"))).withColumnsRenamed({"id": "r", "shared": "right"})
    left = longest_shared(around.select(F.col("l").alias("id"), F.col("lefts").alias("s"))).withColumnsRenamed({"id": "l", "shared": "left"})
    reach = around.select("f", "s", "place", "r", "l").join(right, "r").join(left, "l").join(mixed.select("f", "s", "n"), ["f", "s"])
    low, high = F.greatest(near, F.lit(length) - F.col("right")), F.least(far, F.col("left"))
    single = F.col("n") == 1
    reach = reach.select("f", "s", single.alias("single"), F.when(single, low).otherwise(near).alias("low"), F.when(single, high).otherwise(far).alias("high"))
    reach = cut(reach.filter("low <= high").distinct(), "reach")  # a repeated row may have been taken by several tasks
    asked = reach.filter("single").groupBy("f").agg(F.min("low").alias("from"), F.max("high").alias("to"))
    reach = reach.join(cut(asked, "asked"), "f").withColumns({"low": F.greatest("low", "from"), "high": F.least("high", "to")}).filter("low <= high")
    windows = _windows(reach.join(around.select("f", "s", "rights", "lefts"), ["f", "s"]), length)
    same = cut(windows.groupBy("f", "w").agg(F.count("*").alias("c")).filter("c > 1").select("f", "w"), "same")
    edges = windows.join(same, ["f", "w"]).groupBy("f", "s").agg(F.array_sort(F.collect_set("d")).alias("d"))  # at most ``span`` of a class
    # Neighbouring windows as one stretch: from the farthest one's start to the nearest one's end.
    nearest = F.filter("d", lambda x, i: (i == 0) | (F.get(F.col("d"), i - 1) != x - 1))
    farthest = F.filter("d", lambda x, i: (i == F.size("d") - 1) | (F.get(F.col("d"), i + 1) != x + 1))
    edges = edges.select("f", "s", nearest.alias("near"), farthest.alias("far")).select("f", "s", F.explode(F.arrays_zip("near", "far")).alias("e"))
    edges = edges.join(mixed.filter("n = 1").select("f", "s", "k", "h", "place"), ["f", "s"])
    edges = cut(edges.select("k", "h", (anchor - F.col("e.far")).alias("start"), (anchor - F.col("e.near") + length).alias("stop")), "edges")
    return whole.unionByName(edges)


def _merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered runs of the stretches."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, reached = starts[order], np.maximum.accumulate(stops[order])
    first = np.concatenate([[True], starts[1:] > reached[:-1]])
    return starts[first], reached[np.append(first[1:], True)]


def remove_repeats(docs: DataFrame, length: int = LENGTH, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): each document's removed byte runs and what is left of it, as UTF-8 bytes.

    Matches do not cross documents. A null text counts as empty; a text shorter than ``length`` keeps all. A repeated
    row is a document of its own, so its long strings count as repeated. Other columns are not read. Rows without
    doc_id are kept. An empty table gives no rows.
    """
    texts = keyed_texts(docs, id_col, text_col)
    found = repeated_stretches(texts, length, span)
    found = found.groupBy("k", "h").agg(F.collect_set(F.struct("start", "stop")).alias("stretches"))  # bounded by the text

    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def work(batches: Batches) -> Batches:
        for batch in batches:
            stretches = batch.column("stretches")
            places, offsets = stretches.values, stretches.offsets.to_numpy()
            starts, stops = (places.field(n).to_numpy() for n in ("start", "stop"))
            sizes, spans, kept = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = text.encode()
                a, b = _merged(starts[offsets[i] : offsets[i + 1]], stops[offsets[i] : offsets[i + 1]])
                a, b = a.tolist(), b.tolist()
                sizes.append(len(raw))
                spans.append([{"start": x, "stop": y} for x, y in zip(a, b, strict=True)])
                kept.append(b"".join(raw[x:y] for x, y in zip([0, *b], [*a, len(raw)], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    joined = texts.join(found, ["k", "h"], "left").select("doc_id", "text", F.coalesce("stretches", none).alias("stretches"))
    return map_batches(joined, work, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def digests(kept: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of what :func:`remove_repeats` returns."""
    removed = F.col("n_bytes") - F.length("kept")
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
