"""Language identification by a byte convolutional network (operator 10).

Texts are lower-cased and cut, whole, into overlapping windows of WINDOW bytes. A window's bytes are embedded; filters
of several widths slide over them, each filter keeps its maximum, and a softmax layer gives the languages'
probabilities. A text has the mean over its windows. The network is trained in numpy on a bounded sample of the
labelled rows (``max_rows``); everything else covers all rows. The model is a few ten KB and travels with the tasks.

One pass over the rows, no shuffle beyond the count of rows per language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, map_batches, map_whole_rows, narrow, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
FILTERS = 12  # of each width
EMBEDDING = 6
#: Neighbouring windows share this many bytes, so that no filter position is lost between them.
OVERLAP = max(WIDTHS) - 1
#: Windows that go through the network at once; holds a task's memory to some 10 MB.
BLOCK = 64

UNDETERMINED = "und"
#: Documents with this remainder of crc32(doc_id) by FOLDS are never learned from.
FOLDS, HELD_OUT = 5, 0

_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x E
    filters: np.ndarray  # max width * E x filters; rows beyond a filter's width are 0
    shift: np.ndarray
    dense: np.ndarray  # filters x languages
    bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Embedded bytes under each filter position: windows x positions x (max width * E)."""
        embedded = self.embedding[windows]
        n, length, size = embedded.shape
        row, item = embedded.strides[0], embedded.strides[1]
        view = np.lib.stride_tricks.as_strided(embedded, (n, length - OVERLAP, size * (OVERLAP + 1)), (row, item, embedded.itemsize))
        return np.ascontiguousarray(view)

    def pooled(self, columns: np.ndarray) -> np.ndarray:
        n, positions, size = columns.shape
        return (columns.reshape(-1, size) @ self.filters).reshape(n, positions, -1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = []
        for at in range(0, len(windows), BLOCK):
            best = self.pooled(self.columns(windows[at : at + BLOCK])).max(axis=1) + self.shift
            parts.append(softmax(np.maximum(best, 0) @ self.dense + self.bias))
        return np.concatenate(parts)


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(text: str) -> np.ndarray:
    """The whole text as windows x WINDOW bytes; the last is filled up with 0."""
    raw = np.frombuffer(text.lower().encode("utf-8"), dtype=np.uint8)
    step = WINDOW - OVERLAP
    n = max(1, -(-(len(raw) - OVERLAP) // step))
    padded = np.zeros(n * step + OVERLAP, dtype=np.uint8)
    padded[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64, steps: int = 600, seed: int = 7) -> Network:
    """Adam on the cross entropy, with a fixed seed; more epochs if few windows would give fewer steps."""
    epochs = max(epochs, -(-steps // -(-len(windows) // batch)))
    random = np.random.default_rng(seed)
    size, filters = EMBEDDING * max(WIDTHS), FILTERS * len(WIDTHS)
    open_rows = np.zeros((size, filters), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        open_rows[: width * EMBEDDING, i * FILTERS : (i + 1) * FILTERS] = 1
    normal = lambda *shape, scale: random.normal(0, scale, shape).astype(np.float32)
    net = Network(
        languages,
        normal(256, EMBEDDING, scale=0.5),
        normal(size, filters, scale=0.3) * open_rows,
        np.zeros(filters, dtype=np.float32),
        normal(filters, len(languages), scale=0.2),
        np.zeros(len(languages), dtype=np.float32),
    )
    weights = [net.embedding, net.filters, net.shift, net.dense, net.bias]
    first, second, at_step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for at in range(0, len(order), batch):
            own = order[at : at + batch]
            grads = _gradients(net, windows[own], labels[own], open_rows)
            at_step += 1
            for w, g, a, b in zip(weights, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= 0.01 * (a / (1 - 0.9**at_step)) / (np.sqrt(b / (1 - 0.999**at_step)) + 1e-8)
    return net


def _gradients(net: Network, windows: np.ndarray, labels: np.ndarray, open_rows: np.ndarray) -> list[np.ndarray]:
    n, rows = len(windows), np.arange(len(windows))
    columns = net.columns(windows)
    scores = net.pooled(columns)
    where = scores.argmax(axis=1)  # windows x filters
    best = np.take_along_axis(scores, where[:, None, :], axis=1)[:, 0] + net.shift
    active = np.maximum(best, 0)
    error = softmax(active @ net.dense + net.bias)
    error[rows, labels] -= 1
    error /= n
    back = (error @ net.dense.T) * (best > 0)
    seen = columns[rows[:, None], where]  # windows x filters x (width * E): what each filter saw at its maximum
    g_filters = np.einsum("nf,nfd->df", back, seen) * open_rows
    g_seen = back[:, :, None] * net.filters.T[None]
    g_embedding = np.zeros_like(net.embedding)
    for k in range(OVERLAP + 1):
        touched = windows[rows[:, None], where + k]
        np.add.at(g_embedding, touched, g_seen[:, :, k * EMBEDDING : (k + 1) * EMBEDDING])
    return [g_embedding, g_filters, back.sum(axis=0), active.T @ error, error.sum(axis=0)]


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents that are never learned from; those without an id are among them."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def learn(docs: DataFrame, max_rows: int = 4000, windows_each: int = 4, max_languages: int = 200, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network | None:
    """Train on at most ``max_rows`` labelled documents outside the held-out fold, as many of each language.

    Documents are drawn by a hash of doc_id and text, so the draw does not depend on partitions or retries, an id with
    many rows is drawn like others, and rows that repeat are drawn once. Each gives up to ``windows_each`` windows spread
    over its whole text. Of more languages the ``max_languages`` with most rows are learned. None if no row has a language
    and a text with letters.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    largest = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(min(max_languages, max_rows))
    counts = {r["lang"]: r["n"] for r in largest.collect()}
    if not counts:
        return None
    share = max(1, max_rows // len(counts))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text", F.lit(seed := 11)))
    place = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    limit = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, share / n))])[F.col("lang")]

    def work(batches: Batches) -> Batches:
        for batch in batches:
            cuts = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                own = windows_of(text)
                random = np.random.default_rng([seed, h & 0xFFFFFFFF])
                cuts.append([own[i].tobytes() for i in sorted(random.choice(len(own), min(windows_each, len(own)), replace=False))])
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), pa.array(cuts, pa.list_(pa.binary()))], ["lang", "h", "cuts"])

    drawn = map_batches(rows.filter(place < limit).select("lang", "h", "text"), work, "lang string, h long, cuts array<binary>")
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    drawn = drawn.dropDuplicates(["lang", "h"]).withColumn("rank", first).filter(F.col("rank") <= share)
    drawn = drawn.select("lang", F.explode("cuts").alias("cut")).collect()
    drawn.sort(key=lambda r: (r["lang"], bytes(r["cut"])))
    languages = sorted({r["lang"] for r in drawn})
    if not languages:
        return None
    windows = np.stack([np.frombuffer(r["cut"], dtype=np.uint8) for r in drawn])
    return train(windows, np.array([languages.index(r["lang"]) for r in drawn]), languages)


def language_of(network: Network | None, text: str | None) -> tuple[str, float]:
    if not network or not text or not _LETTER.search(text):
        return UNDETERMINED, 0.0
    mean = network.probabilities(windows_of(text)).mean(axis=0)
    top = int(mean.argmax())
    return network.languages[top], float(min(1.0, mean[top]))


def _judged(network: Network | None, texts: pa.Array) -> list[pa.Array]:
    found = [language_of(network, text) for text in texts.to_pylist()]
    return [pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())]


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every whole text.

    ``lang_pred`` is a learned language, or ``und`` with score 0 if the text is null, empty or has no letter, or if
    nothing could be learned. Of equal probabilities the first language in alphabetical order counts. Repeated rows
    and null doc_ids (held out) are kept; other columns are not read. An empty table gives no rows.
    """

    def work(batches: Batches) -> Batches:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_judged(network, batch.column("text"))], ["doc_id", "lang_pred", "score"])

    found = map_batches(texts_of(docs, id_col, text_col), work, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def confident_documents(docs: DataFrame, network: Network | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` whose whole text is in a learned language with a score of at least ``least``."""

    def work(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        judged = [language_of(network, text) for text in batch.column(at).to_pylist()]
        return batch.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in judged], pa.bool_()))

    return map_whole_rows(docs, work, text_col)
