"""Byte-level BPE encoding and decoding (operator 4).

Each match of the split pattern is merged on its own. The pairs of a pre-token wait in buckets, one per merge rank,
that hold positions of a linked list; a two-level bitmap over the ranks finds the lowest bucket that is not empty
with two find-first-set steps. A merge only unlinks one node and files at most two new pairs, and entries whose
pair has changed meanwhile are skipped when they come up, so a pre-token of n bytes takes O(n log n) steps
however long it is.

Rows stay where they are: one pass, no shuffle. What a worker remembers of pre-tokens is bounded by CACHE_PIECES.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, map_batches, narrow, texts_of

#: Pre-tokens that a worker remembers; twice as many at most while the older half is let go.
CACHE_PIECES = 400_000
#: Longer pre-tokens are encoded each time they come up.
CACHE_BYTES = 64


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file of the tiktoken library: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Encoder:
    """Ids of pre-tokens under one rank table.

    The rank queue is written out inside :meth:`ids`, as calls would take half of its time: ``buckets`` holds the
    positions of a rank as a heap, ``words`` one bit for each rank with a bucket, ``top`` one bit for each word that
    is not 0. All three are empty again when a pre-token is done, so they are shared by all.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        size = max(ranks.values(), default=0) + 1
        self.shift = max(1, (size.bit_length() + 1) // 2)
        self.words = [0] * ((size >> self.shift) + 1)
        self.bits = [1 << i for i in range(max(1 << self.shift, len(self.words)))]
        self.buckets: dict[int, list[int]] = {}

    def ids(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        rank_of, buckets, words, bits, shift = ranks.get, self.buckets, self.words, self.bits, self.shift
        mask, top, n = (1 << shift) - 1, 0, len(piece)
        after = list(range(1, n + 1))  # start of the next token; also the end of this one
        before = list(range(-1, n))
        waiting = [rank_of(piece[i : i + 2], -1) for i in range(n - 1)]  # rank under which the pair of a position is filed
        waiting.append(-1)
        for i, rank in enumerate(waiting):
            if rank >= 0:
                if rank in buckets:
                    buckets[rank].append(i)  # ascending, so a heap already
                else:
                    buckets[rank] = [i]
                    words[rank >> shift] |= bits[rank & mask]
                    top |= bits[rank >> shift]
        while top:
            word = (top & -top).bit_length() - 1
            held = words[word]
            low = held & -held
            rank = (word << shift) + low.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[word] = held = held ^ low
                if not held:
                    top ^= bits[word]
            if waiting[i] != rank:
                continue  # stale: the pair was merged or has changed
            gone = after[i]
            after[i] = end = after[gone]
            waiting[gone] = -1
            pair = -1
            if end < n:
                before[end] = i
                pair = rank_of(piece[i : after[end]], -1)
            waiting[i] = pair
            left = before[i]
            for at in (i, left) if left >= 0 else (i,):
                if at != i:
                    waiting[at] = pair = rank_of(piece[at:end], -1)
                if pair >= 0:
                    if pair in buckets:
                        heappush(buckets[pair], at)
                    else:
                        buckets[pair] = [at]
                        words[pair >> shift] |= bits[pair & mask]
                        top |= bits[pair >> shift]
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return out


class PieceCache(dict):
    """Pre-token -> its ids as little-endian 32-bit integers. A full cache becomes the older half of the next."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            raw = piece.encode("utf-8")
            packed = np.array(self.encoder.ids(raw), dtype="<u4").tobytes()
            if len(raw) > CACHE_BYTES:
                return packed
        if len(self) >= CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = packed
        return packed


@lru_cache(maxsize=2)
def _cache(path: str) -> PieceCache:
    return PieceCache(Encoder(load_ranks(path)))


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in load_ranks(path).items()}


def encode_text(text: str, path: str, pattern: str) -> bytes:
    pieces = regex.findall(pattern, text)  # the module caches the compiled pattern
    return b"".join(map(_cache(path).__getitem__, pieces))


def decode_ids(ids: bytes, path: str) -> bytes:
    return b"".join(map(_tokens(path).__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _binaries(values: Iterable[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers, as the tiktoken library gives without special tokens.

    A null text counts as empty and has no ids. Repeated rows and null doc_ids are kept, one row each; other columns
    are not read. An empty table gives no rows.
    """

    def work(batches: Batches) -> Batches:
        for batch in batches:
            ids = [encode_text(text, ranks_path, pattern) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _binaries(ids)], ["doc_id", "ids"])

    return map_batches(texts_of(docs, id_col, text_col), work, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of each document's ids. Null ids count as none; an unknown id raises."""
    own = narrow(encoded, doc_id="doc_id", ids="ids").withColumn("ids", F.coalesce("ids", F.lit(b"")))

    def work(batches: Batches) -> Batches:
        for batch in batches:
            decoded = [decode_ids(ids, ranks_path) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), _binaries(decoded)], ["doc_id", "ids", "decoded"])

    return map_batches(own, work, "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what :func:`decode_documents` returns, and columns of it."""
    return decoded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
