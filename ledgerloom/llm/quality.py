"""Document quality by hierarchical empirical Bayes (operator 5).

A logistic classifier judges each text by its make-up. Its odds against the base rate are the document's evidence.
The prior is the document's site: the mean quality of its path, shrunk towards that of its host, shrunk towards the
global mean, each as firmly as the spread between hosts, and between paths of a host, asks for (method of moments). A
path with few documents thus says little, one with many says what it shows. A document never counts in its own prior.

Texts are read once; everything after works on a narrow table. Sites are grouped sums, so a host with a third of all
documents reaches the shuffle as one row per task. The classifier is fitted on a bounded sample of labelled rows
(``max_rows``); means, spreads and posteriors cover all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Batches, cut, map_batches, narrow
from ledgerloom.llm.langid import held_out

_CODES = np.zeros(256, dtype=np.int64)
for _group, _letters in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "#$%&*", "|", "!", ".,;:?'\"-()", " \t", "\n\r"), 1):
    _CODES[[ord(c) for c in _letters]] = _group
_CODES[128:] = 10
_GROUPS = 11

#: Chances are kept this far from 0 and 1.
MARGIN = 1e-4


def features(text: str) -> list[float]:
    """Shares of kinds of bytes, and how words and lines repeat; all 0 for a text without words."""
    raw, words = text.encode(), text.split()
    if not words:
        return [0.0] * (_GROUPS + 7)
    kinds = np.bincount(_CODES[np.frombuffer(raw, dtype=np.uint8)], minlength=_GROUPS) / len(raw)
    lines = text.split("\n")
    letters = kinds[1] + kinds[2] + kinds[10]
    distinct = len(set(words))
    return [
        *kinds.tolist(),
        float(kinds[1] / letters) if letters else 0.0,
        float(np.log1p(len(words))),
        len(raw) / len(words),
        distinct / len(words),
        float(np.log1p(distinct)),
        len(set(lines)) / len(lines),
        1.0,
    ]


@dataclass
class Classifier:
    weights: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    base: float  # share of good rows it was fitted on

    def chance(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(((rows - self.center) / self.scale) @ self.weights, -30, 30)))


def fit(rows: np.ndarray, good: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> Classifier:
    """Logistic regression by Newton steps; the last feature is the constant."""
    center, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    center[-1], scale[-1] = 0.0, 1.0
    x, weights = (rows - center) / scale, np.zeros(rows.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (good - p) - ridge * weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    return Classifier(weights, center, scale, float(np.clip(good.mean(), MARGIN, 1 - MARGIN)))


def _described(docs: DataFrame) -> DataFrame:
    def work(batches: Batches) -> Batches:
        for batch in batches:
            found = [features(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.float64()))], ["doc_id", "host", "path", "x"])

    return map_batches(docs, work, "doc_id long, host string, path string, x array<double>")


def _judged(described: DataFrame, classifier: Classifier) -> DataFrame:
    def work(batches: Batches) -> Batches:
        for batch in batches:
            rows = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(classifier.chance(rows))], ["doc_id", "host", "path", "chance"])

    return map_batches(described, work, "doc_id long, host string, path string, chance double", rows=4096)


def _firmness(groups: DataFrame, mean: str) -> float:
    """Prior observations that the spread of group means around ``mean`` is worth, from columns n and good.

    The spread beyond what chance gives is V = sum(n (m - mean)^2 - mean (1 - mean)) / sum(n); the prior of a group
    then weighs mean (1 - mean) / V - 1 rows, at least 1 and at most 10^6.
    """
    noise = F.col(mean) * (1 - F.col(mean))
    spread = F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(mean), 2) - noise
    row = groups.agg(F.sum(spread).alias("spread"), F.sum("n").alias("n"), F.avg(noise).alias("noise")).first()
    if not row["n"] or row["spread"] <= 0:
        return 1e6
    return float(np.clip(row["noise"] / (row["spread"] / row["n"]) - 1, 1.0, 1e6))


def _logit(chance: Column) -> Column:
    inside = F.greatest(F.least(chance, F.lit(1 - MARGIN)), F.lit(MARGIN))
    return F.log(inside / (1 - inside))


def score(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
    host_col: str = "host", path_col: str = "path", label_col: str = "quality",
) -> DataFrame:
    """(doc_id, held_out, classifier, host_mean, path_mean, score, keep) of every document.

    ``classifier`` is the chance that the text alone gives, ``host_mean`` and ``path_mean`` are the posteriors of its
    site without itself, ``score`` combines them, and ``keep`` says whether it reaches ``threshold``. Labels are 0 or
    1; several of one document count as their mean, null ones not at all. Held-out documents' labels are never used.
    Null hosts and paths are sites of their own, null texts count as empty. Repeated rows and null doc_ids are kept;
    other columns are not read. Without any label the classifier says 0.5. An empty table gives no rows.
    """
    own = narrow(docs, doc_id=id_col, host=host_col, path=path_col, text=text_col)
    own = own.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(c) for c in ("host", "path")], F.col("text").cast("string").alias("text"))
    described = cut(_described(own), "described")
    known = narrow(labels, doc_id=id_col, label=label_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("double").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IS NOT NULL").filter(~held_out()).groupBy("doc_id").agg(F.avg("label").alias("label"))

    labelled = described.join(known, "doc_id").select("doc_id", "x", "label")
    chance = min(1.0, max_rows / max(1, known.count()))
    labelled = labelled.withColumn("h", F.xxhash64("doc_id", "x", F.lit(23)))  # repeated rows are drawn once
    place = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = labelled.filter(place < chance).dropDuplicates(["h"]).orderBy(place, "h").limit(max_rows).collect()
    if drawn:
        drawn.sort(key=lambda r: (r["doc_id"], r["x"]))
        classifier = fit(np.array([r["x"] for r in drawn]), np.array([r["label"] for r in drawn]))
    else:
        width = len(features(""))
        classifier = Classifier(np.zeros(width), np.zeros(width), np.ones(width), 0.5)

    judged = _judged(described, classifier).join(known, "doc_id", "left").withColumn("good", F.coalesce("label", "chance")).drop("label")
    judged = cut(judged, "judged")
    paths = judged.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
    paths = cut(paths, "paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = (total["good"] / total["n"]) if total["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    per_host = _firmness(hosts.withColumn("mean", F.lit(mean)), "mean")
    hosts = hosts.withColumnsRenamed({"n": "host_n", "good": "host_good"})
    shrunk = paths.join(hosts, "host").withColumn("mean", (F.col("host_good") + per_host * mean) / (F.col("host_n") + per_host))
    per_path = _firmness(shrunk, "mean")
    sites = shrunk.select("host", "path", "n", F.col("good").alias("path_good"), "host_n", "host_good")

    found = judged.join(sites, ["host", "path"])
    found = found.withColumn("host_mean", (F.col("host_good") - F.col("good") + per_host * mean) / (F.col("host_n") - 1 + per_host))
    found = found.withColumn("path_mean", (F.col("path_good") - F.col("good") + per_path * F.col("host_mean")) / (F.col("n") - 1 + per_path))
    odds = _logit(F.col("path_mean")) + _logit(F.col("chance")) - float(np.log(classifier.base / (1 - classifier.base)))
    found = found.withColumn("score", 1 / (1 + F.exp(-odds)))
    return found.select("doc_id", held_out().alias("held_out"), F.col("chance").alias("classifier"), "host_mean", "path_mean", "score", (F.col("score") >= threshold).alias("keep"))
