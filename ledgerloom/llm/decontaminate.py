"""Benchmark decontamination by pigeonhole edit matching (operator 2).

Texts and test items are compared as words: lower case, punctuation and white space as one blank. An item of n
characters may differ by k = floor(rate * n) edits. It is split into k + 1 pieces, so a passage within k edits holds at
least one piece unchanged. One automaton finds all pieces of all items in one run over a text; around each hit
Myers' bit-parallel algorithm gives the least edit distance of the item to any stretch there.

The items are a test set and go to the tasks in blocks of at most BLOCK_CHARS; a larger set takes several passes over
the documents, one block in memory at a time. Documents are not moved.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, map_whole_rows, narrow, texts_of, with_ids

#: Characters of the items that one automaton holds; some 40 bytes of memory each.
BLOCK_CHARS = 4_000_000
#: Shorter items are found only as whole documents, as ordinary prose holds such stretches by chance.
MIN_CHARS = 24
ERROR_RATE = 0.08

_OTHER = "\x80-\xa0\xab\xbb\u2000-\u206f\u3000"
_OTHER_BREAKS = re.compile(f"[{_OTHER}]+")
_ASCII_BREAKS = bytes(b for b in range(128) if not chr(b).isalnum())
_TO_BLANK = bytes.maketrans(_ASCII_BREAKS, b" " * len(_ASCII_BREAKS))
_WORD = re.compile("[^" + re.escape(_ASCII_BREAKS.decode()) + _OTHER + "]+")


def normal(text: str) -> str:
    if not text.isascii():
        text = _OTHER_BREAKS.sub(" ", text)
    return b" ".join(text.lower().encode("utf-8").translate(_TO_BLANK).split()).decode("utf-8")


def best_end(item: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the stretch of ``text`` nearest to ``item``, the first of equals; None if over ``most``."""
    m = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score, found = full, 0, m, None
    for end, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        same = ((((eq & up) + up) ^ up) | eq | down) & full
        rise = down | (full & ~(same | up))
        fall = up & same
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full  # a stretch may begin anywhere, so row 0 stays 0
        vertical = eq | down
        up = (fall | (full & ~(vertical | rise))) & full
        down = rise & vertical
        if score <= most and (found is None or score < found[0]):
            found = score, end
            if not score:
                break
    return found


def nearest(item: str, text: str, most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the nearest stretch; of equals the first to end, and of these the shortest."""
    ending = best_end(item, text, most)
    if ending is None:
        return None
    distance, end = ending
    back = best_end(item[::-1], text[:end][::-1], distance)
    return distance, end - back[1], end


class Pieces:
    """The automaton over all pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], rate: float) -> None:
        self.items = [(item_id, normal(text)) for item_id, text in items]
        self.most = [int(rate * len(text)) for _, text in self.items]
        self.short: dict[str, list[int]] = defaultdict(list)
        self.size = 0
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, text) in enumerate(self.items):
            if len(text) < MIN_CHARS:
                if text:
                    self.short[text].append(i)
                continue
            parts = self.most[i] + 1
            for p in range(parts):
                a, b = len(text) * p // parts, len(text) * (p + 1) // parts
                places[text[a:b]].append((i, b))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        self.automaton.make_automaton()
        self.empty = not places

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(index of the item, distance, start, end) in the normal text, the best one of each item."""
        found = [(i, 0, 0, len(text)) for i in self.short.get(text, ())]
        if self.empty or not text:
            return found
        begins: dict[int, list[int]] = defaultdict(list)
        for end, where in self.automaton.iter(text):
            for i, offset in where:
                begins[i].append(end + 1 - offset)
        for i, starts in begins.items():
            item, most, best = self.items[i][1], self.most[i], None
            starts.sort()
            at = 0
            while at < len(starts):  # hits whose windows overlap are looked at together
                low, high = max(0, starts[at] - most), starts[at] + len(item) + most
                while at < len(starts) and starts[at] - most <= high:
                    high = starts[at] + len(item) + most
                    at += 1
                near = nearest(item, text[low:high], most if best is None else best[0] - 1)
                if near:
                    best = near[0], low + near[1], low + near[2]
                    if not best[0]:
                        break
            if best:
                found.append((i, *best))
        return found


@lru_cache(maxsize=1)
def _pieces(items: tuple[tuple[int, str], ...], rate: float) -> Pieces:
    return Pieces(list(items), rate)


def original_span(text: str, plain: str, start: int, end: int) -> tuple[int, int]:
    """The words of ``text`` that a stretch of its normal form touches."""
    words = list(_WORD.finditer(text))
    first = plain.count(" ", 0, start) + (plain[start] == " ")
    last = plain.count(" ", 0, end - (plain[end - 1] == " "))
    return words[first].start(), words[max(first, last)].end()


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, budget, start, end): each test item found in each document, at its best place.

    ``start`` and ``end`` are code points of the document's whole words. Null texts and items without words match
    nothing. Documents without a match give no row. Repeated documents and items give a row each, null ids included;
    other columns are not read. An empty table on either side gives no rows.
    """
    own = texts_of(docs, id_col, text_col)
    found = None
    for items, last in _blocks(benchmark, item_id_col, item_text_col):
        part = _matches(own, items, rate)
        part = part if last and found is None else cut(part)
        found = part if found is None else found.unionByName(part)
    return found


def _blocks(benchmark: DataFrame, item_id_col: str, item_text_col: str) -> Iterator[tuple[tuple[tuple[int, str], ...], bool]]:
    """The items in blocks of at most some BLOCK_CHARS, one in memory at a time, and whether it is the last."""
    items = narrow(benchmark, item_id=item_id_col, text=item_text_col).select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield tuple(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))), block == blocks - 1


def _matches(docs: DataFrame, items: tuple[tuple[int, str], ...], rate: float) -> DataFrame:
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "item_id", "distance", "budget", "start", "end")])

    def work(batches: Batches) -> Batches:
        pieces = _pieces(items, rate)
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                plain = normal(text)
                for i, distance, start, end in pieces.matches(plain):
                    rows.append((doc_id, pieces.items[i][0], distance, pieces.most[i], *original_span(text, plain, start, end)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], schema=schema)

    return map_batches(docs, work, "doc_id long, item_id long, distance long, budget long, start long, end long")


def clean_documents(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows and columns of ``docs`` whose doc_id has no row with a test item in its ``text``; rows without id count as one document.

    See :func:`clean_rows` for tables where rows of one id are documents of their own.
    """
    items = narrow(benchmark, item_id="item_id", text="text")
    return with_ids(docs, "doc_id", find_leaks(docs, items, rate).select("doc_id").distinct(), "left_anti")


def clean_rows(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` whose own whole text holds no test item, whatever their ids; null texts hold none."""
    for items, last in _blocks(benchmark, item_id_col, item_text_col):
        docs = _without(docs, items, rate, text_col)
        docs = docs if last else cut(docs)
    return docs


def _without(docs: DataFrame, items: tuple[tuple[int, str], ...], rate: float, text_col: str) -> DataFrame:
    def work(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        pieces = _pieces(items, rate)
        return batch.filter(pa.array([not (text and pieces.matches(normal(text))) for text in batch.column(at).to_pylist()], pa.bool_()))

    return map_whole_rows(docs, work, text_col)
