"""Grouping of spelling variants by a bit-sliced position index (operator 11).

The vocabulary is counted over whole texts. An index holds, for each position and letter, the set of its words with
that letter there, as the bits of one integer. A query goes through its letters once and keeps, for all words of the
index at a time, those that agree so far (zero errors) and those that agree but for one replaced letter, one letter
more or one letter less; the last two read the positions shifted by one.

One index over a large vocabulary would meet each query with every word, so words meet in blocks. Two words that differ
by one edit, the shorter of them of l letters, agree in the first l // 2 letters or in the last l - l // 2 ones. A block
holds the words of l and l + 1 letters with one such half; its words of l letters are the queries. A block of more than
``CHUNK`` words is split into several indexes, and its queries go to each of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, narrow, partitions

#: A run loses a letter if its hash is divisible by this.
DAMAGE = 31
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: Words of one index; its bitsets take some 2 KB for each position and letter.
CHUNK = 1 << 14
#: Different words that a task counts before it passes them on, and queries that it holds.
HELD = 1 << 17

_RUNS = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)  # a shorter run is no word, with or without a letter lost


def damaged(run: str, doc_id: str) -> str:
    """The run as it counts: without one letter where the hash of document and run says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % DAMAGE else run[: h % len(run)] + run[h % len(run) + 1 :]


def words_of(text: str, doc_id: str) -> Counter[str]:
    """Words of at least MIN_LENGTH letters and how often they occur; only A-Z are lower-cased."""
    found: Counter[str] = Counter()
    for run, n in Counter(_RUNS.findall(text.encode().lower().decode())).items():  # bytes: ASCII letters only
        word = damaged(run, doc_id)
        if len(word) >= MIN_LENGTH:
            found[word] += n
    return found


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words with at least MIN_COUNT occurrences. A null text has none; a null id hashes as the empty string."""

    def count(batches: Batches) -> Batches:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                held.update(words_of(text, doc_id))
                if len(held) >= HELD:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    def rows(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    own = narrow(docs, id=id_col, text=text_col)
    own = own.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("id", "text")])
    return map_batches(own, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


class PositionIndex:
    """Bitsets over a list of words: bit i of ``slices[p][letter]`` is set if word i has the letter at place p."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = int(lengths.max(initial=0))
        codes = np.zeros((len(words), width), dtype=np.uint32)
        flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        row = np.repeat(np.arange(len(words)), lengths)
        codes[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        self.slices = [{chr(c): self._bits(codes[:, p] == c) for c in np.unique(codes[:, p]).tolist() if c} for p in range(width)]
        self.of_length = {n: self._bits(lengths == n) for n in np.unique(lengths).tolist()}
        self.all = (1 << len(words)) - 1

    @staticmethod
    def _bits(members: np.ndarray) -> int:
        return int.from_bytes(np.packbits(members, bitorder="little").tobytes(), "little")

    def near(self, word: str, apart: int = 0) -> tuple[int, int, int]:
        """Words that differ from ``word`` by one letter replaced, one more, and one less, as bitsets.

        With ``apart``, only words that differ from it in the first so many letters already.
        """
        n, slices, width = len(word), self.slices, len(self.slices)
        same, replaced, more, less, agree = self.all, 0, self.all, 0, 0
        for i, letter in enumerate(word):
            here = slices[i].get(letter, 0) if i < width else 0
            after = slices[i + 1].get(letter, 0) if i + 1 < width else 0
            before = slices[i - 1].get(letter, 0) if 0 < i <= width else 0
            less = less & before | same
            replaced = replaced & here | same & ~here
            same &= here
            more = more & after | same
            if i + 1 == apart:
                agree = same
            if not (same or replaced or more or less):
                break
        lengths = self.of_length
        return replaced & lengths.get(n, 0) & ~agree, more & lengths.get(n + 1, 0) & ~agree, less & lengths.get(n - 1, 0) & ~agree

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield low.bit_length() - 1
            bits ^= low


def _blocks(words: DataFrame) -> DataFrame:
    """(side, l, half, index, asks, chunk, word, n): each word in its four blocks, as a query only where it is one of the shorter ones."""
    length, l = F.length("word"), F.col("l")
    halves = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), F.floor(l / 2).cast("int")).alias("half")),
        F.struct(F.lit(1).alias("side"), F.expr("right(word, CAST(l - floor(l / 2) AS INT))").alias("half")),
    )
    placed = words.select("*", F.explode(F.array(length, length - 1)).alias("l")).select("*", F.explode(halves).alias("at"))
    placed = placed.select("at.side", "l", "at.half", "word", "n", (length == l).alias("asks"))
    key = ["side", "l", "half"]
    sizes = placed.groupBy(*key).agg(F.count("*").alias("size"), F.max("asks").alias("asked"))
    # A block without queries or of one word has nothing to tell.
    sizes = cut(sizes.filter("asked AND size > 1").select(*key, F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")), "blocks")
    placed = placed.join(sizes, key)
    chunk = F.pmod(F.xxhash64("word"), F.col("chunks").cast("long")).cast("int")
    whole = F.array(F.struct(F.lit(True).alias("index"), F.col("asks").alias("asks"), chunk.alias("chunk")))
    everywhere = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct((c == chunk).alias("index"), F.col("asks").alias("asks"), c.alias("chunk")))
    role = F.explode(F.when(F.col("asks") & (F.col("chunks") > 1), everywhere).otherwise(whole)).alias("role")
    return placed.select(*key, "word", "n", role).select(*key, "role.*", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): for each word with near words their number, and the one of largest n (ties: smallest).

    ``words`` has one row (word, n) for each word. Words are near if they differ by exactly one inserted, deleted or
    replaced code point.
    """

    def compare(batches: Batches) -> Batches:
        key, words, counts, queries, index, out = None, [], [], [], None, []

        def run() -> None:
            nonlocal index
            if not queries or len(words) + len(queries) < 2:
                return
            index = index or PositionIndex(words)
            side, l, _, _ = key
            for word, n in queries:
                replaced, more, _ = index.near(word, l // 2 if side else 0)  # pairs that share both halves count in the first
                both = [*index.members(replaced), *index.members(more)]
                if both:
                    best = min(both, key=lambda i: (-counts[i], words[i]))
                    out.append((word, len(both), counts[best], words[best]))
                    out.extend((words[i], 1, n, word) for i in index.members(more))
            queries.clear()

        for batch in batches:
            for *own, is_index, asks, word, n in zip(*(batch.column(c).to_pylist() for c in ("side", "l", "half", "chunk", "index", "asks", "word", "n")), strict=True):
                if own != key:
                    run()
                    key, index = own, None
                    words, counts, queries = [], [], []
                if is_index:
                    words.append(word)
                    counts.append(n)
                if asks:
                    queries.append((word, n))
                    if not is_index and len(queries) >= HELD:  # all words of the index came before
                        run()
            if out:
                yield rows(out)
                out = []
        run()
        yield rows(out)

    def rows(out: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["word", "n_near", "near_n", "near"])

    key = ["side", "l", "half", "chunk"]
    blocks = _blocks(words).repartition(partitions(words.sparkSession), *key).sortWithinPartitions(*key, F.col("index").desc())
    found = map_batches(blocks, compare, "word string, n_near long, near_n long, near string", rows=4096)
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("best.word").alias("near"), (-F.col("best.n")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the links (word, form), one for each word: the last word of the chain of forms.

    Each round doubles the length of the way behind a word, so a chain of c forms takes log2 c rounds. The links must
    hold no cycle.
    """
    now = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = now.join(ahead, "root", "left")
        if then.filter("next IS NOT NULL").isEmpty():
            return now
        now = cut(then.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row for each word of the vocabulary.

    A word's form is its near word of largest n, if that n is at least RATIO times its own; root is the last word of the
    chain of forms, or the word itself. A repeated row counts as often as it is there; null and empty texts have no words; a
    null id hashes as the empty string. Other columns are not read. A table without words gives no rows.
    """
    words = cut(vocabulary(docs, id_col, text_col), "words")
    near = words.join(neighbours(words), "word", "left")
    formed = F.col("near_n") >= RATIO * F.col("n")
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n"))
    near = cut(near, "near")
    # n grows with each form, so the chains end.
    ends = roots(near.filter("form IS NOT NULL").select("word", "form"))
    return near.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
