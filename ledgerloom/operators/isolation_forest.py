"""Isolation Forest over a distributed table (Liu, Ting and Zhou, 2008).

Only the per-tree samples move: rows are hashed to trees, each task grows whole trees from at most
a few hundred rows, and the finished forest (at most ``trees * (2 * sample - 1)`` small nodes) is
sent to the executors, which score their own rows in Arrow batches. No data row reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.quantiles import approx_quantiles, exact_quantiles
from ledgerloom.operators.features import filled, medians, usable_rows, with_any_feature
from ledgerloom.session import scratch_dir
from ledgerloom.sources.lake import Lake

# Settings of the detection job.
TREES = 200
SEED = 42
SAMPLE = 256
CONTAMINATION = 0.05
CONTAMINATION_RANGE = (0.01, 0.20)

# Draws that a tree gets for each row it keeps: with 1.5 x 256 of them it hardly ever falls short of 256.
OVERSAMPLE = 1.5
_BUCKETS = 1 << 30

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, split double, left_node int, right_node int, "
    "size int, depth int"
)


def path_correction(n: np.ndarray | float) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype="float64")
    safe = np.maximum(n, 3.0)
    large = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, large))


def grow_tree(points: np.ndarray, tree_id: int, seed: int, depth_limit: int) -> pd.DataFrame:
    """Node table of one tree over ``points`` (rows x features); leaves have feature -1.

    All nodes of a level are split at once: the rows stay sorted by node, so each node is a slice.
    A right child always has the number after its left sibling.
    """
    random = np.random.default_rng([seed, tree_id])
    levels = []
    node, starts, next_id = np.array([0]), np.array([0]), 1
    for depth in range(depth_limit + 1):
        sizes = np.diff(np.append(starts, len(points)))
        low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
        varies = high > low
        splits = varies.any(axis=1) & (depth < depth_limit)
        turn, place = random.random((2, len(starts)))
        feature = (np.cumsum(varies, axis=1) > np.floor(turn * varies.sum(axis=1))[:, None]).argmax(axis=1)
        each = np.arange(len(starts))
        bottom, top = low[each, feature], high[each, feature]
        at = np.clip(bottom + place * (top - bottom), bottom, np.nextafter(top, bottom))
        left = np.where(splits, next_id + 2 * (np.cumsum(splits) - 1), -1)
        levels.append(
            pd.DataFrame(
                {
                    "tree_id": tree_id,
                    "node_id": node,
                    "feature": np.where(splits, feature, -1),
                    "split": np.where(splits, at, 0.0),
                    "left_node": left,
                    "right_node": np.where(splits, left + 1, -1),
                    "size": sizes,
                    "depth": depth,
                }
            )
        )
        if not splits.any():
            break
        owner = np.repeat(each, sizes)
        child = left[owner] + (points[np.arange(len(points)), feature[owner]] > at[owner])
        stays = splits[owner]
        order = np.argsort(child[stays], kind="stable")
        points = points[stays][order]
        node, starts = np.unique(child[stays][order], return_index=True)
        next_id += 2 * int(splits.sum())
    return pd.concat(levels, ignore_index=True)


def tree_samples(
    df: DataFrame, features: list[str], rows: int, trees: int, sample: int, seed: int, identity: list[str] | None = None
) -> DataFrame:
    """(tree_id, row_hash, copies, features): the candidate rows of each tree, some 1.5 samples for each.

    Every physical row is offered to its share of the trees, to each at most once; where a table has no more than 1.5
    samples of rows, that is all of them. The draws come from a hash of the identity and the features, so they are the
    same for any partitioning and any task retry. With ``identity`` the rows count as different and only drawn ones
    move. Without it equal rows are first reduced to one with a count, and draw as often as they are.
    """
    keys = [*(c for c in identity or () if c not in features), *features]
    hashed = df.select(F.xxhash64(F.lit(seed), *[F.col(c) for c in keys]).alias("row_hash"), *features)
    share = min(trees, trees * OVERSAMPLE * sample / max(1, rows))
    n = F.lit(1)
    if identity is None:
        hashed = hashed.groupBy("row_hash", *features).agg(F.count(F.lit(1)).alias("n"))
        n = F.col("n")
    wanted = n * F.lit(share)
    rest = F.pmod(F.xxhash64("row_hash", F.lit(-1)), F.lit(_BUCKETS)) / F.lit(float(_BUCKETS)) < wanted - F.floor(wanted)
    drawn = hashed.withColumn("draws", (F.floor(wanted) + rest.cast("int")).cast("int")).filter("draws > 0")
    # The draws of a row go to neighbouring trees from a hashed one on: no tree twice before all had one.
    first = F.pmod(F.xxhash64("row_hash", F.lit(-2)), F.lit(trees))
    turn = F.explode(F.sequence(F.lit(0), F.col("draws") - 1))
    placed = drawn.withColumn("first", first).withColumn("turn", turn)
    placed = placed.withColumn("tree_id", F.pmod(F.col("first") + F.col("turn"), F.lit(trees)).cast("int"))
    return placed.groupBy("tree_id", "row_hash", *features).agg(F.count(F.lit(1)).alias("copies"))


def fit_nodes(
    df: DataFrame,
    features: list[str],
    rows: int,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
    identity: list[str] | None = None,
) -> DataFrame:
    """Forest as a node table; ``df`` holds complete double features, ``rows`` is its row count."""
    size = min(sample, rows)
    depth_limit = math.ceil(math.log2(max(size, 2)))

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree_id = int(key[0])
        group = group.sort_values("row_hash")
        copies = group["copies"].to_numpy()
        row = np.repeat(np.arange(len(group)), copies)
        copy = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
        mixed = group["row_hash"].to_numpy()[row] + copy * 7_919 + tree_id
        chosen = row[np.argsort(pd.util.hash_array(mixed), kind="stable")[:size]]
        return grow_tree(group[features].to_numpy("float64")[chosen], tree_id, seed, depth_limit)

    samples = tree_samples(df, features, rows, trees, size, seed, identity)
    # A stated number keeps the few small trees from being grown in one or two coalesced tasks.
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    return samples.repartition(tasks, "tree_id").groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)


@dataclass(frozen=True)
class Forest:
    """A fitted forest as arrays of shape (trees, nodes)."""

    features: tuple[str, ...]
    fill: dict[str, float]
    sample: int
    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray  # the left child; the right one has the next number
    path: np.ndarray  # path length credited to a row that ends in this leaf

    @classmethod
    def from_nodes(
        cls, nodes: DataFrame, features: list[str], fill: dict[str, float], sample: int, trees: int | None = None
    ) -> Forest:
        """Collect the node table; its size is bounded by trees and sample, not by the data.

        Raises if one of ``trees`` is missing or grew from fewer than ``sample`` rows.
        """
        table = nodes.toPandas().sort_values(["tree_id", "node_id"])
        roots = table.loc[table["node_id"] == 0, "size"]
        if trees is not None and (len(roots) != trees or (roots != sample).any()):
            raise ValueError(
                f"{len(roots)} of {trees} trees, the smallest from {roots.min() if len(roots) else 0} of {sample} rows: "
                "the identity does not tell rows apart, or the row count is wrong"
            )
        tree = pd.factorize(table["tree_id"], sort=True)[0]
        shape = (tree.max() + 1, table["node_id"].max() + 1)

        def grid(values: np.ndarray, default: float) -> np.ndarray:
            out = np.full(shape, default, dtype=values.dtype)
            out[tree, table["node_id"]] = values
            return out

        node = table["node_id"].to_numpy()
        leaf = table["feature"].to_numpy() < 0
        # A row that has reached its leaf stays there: nothing is greater than infinity.
        return cls(
            tuple(features),
            dict(fill),
            sample,
            grid(np.where(leaf, 0, table["feature"]).astype("intp"), 0),
            grid(np.where(leaf, np.inf, table["split"]), np.inf),
            grid(np.where(leaf, node, table["left_node"]).astype("intp"), 0),
            grid(table["depth"].to_numpy("float64") + path_correction(table["size"].to_numpy()), 0.0),
        )

    def mean_path(self, points: np.ndarray) -> np.ndarray:
        """Mean path length of each row over all trees.

        All rows step down one level at a time; the buffers are reused, as allocating them anew
        costs more than the steps.
        """
        rows, width = points.shape
        values, start = points.ravel(), np.arange(rows) * width
        node, step, place = (np.empty(rows, dtype="intp") for _ in range(3))
        value, limit, total = np.empty(rows), np.empty(rows), np.zeros(rows)
        right = np.empty(rows, dtype=bool)
        levels = math.ceil(math.log2(max(self.sample, 2)))
        for feature, split, child, path in zip(self.feature, self.split, self.child, self.path, strict=True):
            node.fill(0)
            for _ in range(levels):
                np.add(feature.take(node, out=place, mode="clip"), start, out=place)
                values.take(place, out=value, mode="clip")
                np.greater(value, split.take(node, out=limit, mode="clip"), out=right)
                np.add(child.take(node, out=step, mode="clip"), right, out=node)
            total += path.take(node, out=value, mode="clip")
        return total / len(self.feature)

    def score(self, spark: SparkSession) -> Column:
        """Score of a row in (-1, 0); lower is more anomalous."""
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def mean_path(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            forest = shared.value
            for batch in batches:
                yield pd.Series(forest.mean_path(np.ascontiguousarray(batch.to_numpy("float64"))))

        # One struct rather than several columns, as a lone column would arrive in another form.
        length = mean_path(F.struct(*filled(list(self.features), self.fill)))
        return -F.pow(F.lit(2.0), -length / float(path_correction(self.sample)))


def fit(
    df: DataFrame,
    features: list[str],
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
    exact: bool = True,
    identity: list[str] | None = None,
) -> Forest:
    """Fit on the rows that have any feature; gaps are filled with the median.

    ``identity`` names the columns that tell rows apart, such as the key; without it equal rows are counted, which
    moves every distinct row once. No other column is read. The forest remembers fill values only for the features
    that had gaps.
    """
    nodes, fill, size = _fitted(df, features, trees, sample, seed, exact, identity)
    return Forest.from_nodes(nodes, features, fill, size, trees)


def _fitted(
    df: DataFrame, features: list[str], trees: int, sample: int, seed: int, exact: bool, identity: list[str] | None
) -> tuple[DataFrame, dict[str, float], int]:
    """Node table, fill values and rows of each tree."""
    usable = with_any_feature(df, features)
    rows, gaps = usable_rows(usable, features)
    fill = medians(usable, gaps, exact)
    others = [F.col(c) for c in identity or () if c not in features]
    complete = usable.select(*others, *filled(features, fill))
    return fit_nodes(complete, features, rows, trees, sample, seed, identity), fill, min(sample, rows)


NODES, SETTINGS = "forest_nodes", "forest_settings"
SETTINGS_SCHEMA = "feature int, name string, fill double, sample int, trees int"


def fit_stored(
    lake: Lake,
    df: DataFrame,
    features: list[str],
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
    exact: bool = True,
    identity: list[str] | None = None,
) -> Forest:
    """:func:`fit`, with the forest kept as ``ai.forest_nodes`` and ``ai.forest_settings``, so that later runs score with the same one."""
    nodes, fill, size = _fitted(df, features, trees, sample, seed, exact, identity)
    lake.replace("ai", NODES, nodes)
    rows = [(i, name, fill.get(name), size, trees) for i, name in enumerate(features)]
    lake.replace("ai", SETTINGS, lake.spark.createDataFrame(rows, SETTINGS_SCHEMA).coalesce(1))
    return load_forest(lake)


def load_forest(lake: Lake) -> Forest:
    """The stored forest; one with a missing or short tree is refused."""
    settings = lake.read("ai", SETTINGS).orderBy("feature").collect()  # one row for each feature
    fill = {r.name: r.fill for r in settings if r.fill is not None}
    return Forest.from_nodes(lake.read("ai", NODES), [r.name for r in settings], fill, settings[0].sample, settings[0].trees)


def mean_paths_by_joins(df: DataFrame, lake: Lake, key: str) -> DataFrame:
    """(key, mean_path) of each usable row from the stored forest, by one join with its trees.

    The same as :meth:`Forest.mean_path` without Python: each row meets every tree, whose nodes are arrays by number, and
    steps down within its row, so a level costs three look-ups and no join. The trees are at most trees * (2 * sample - 1)
    nodes. A row's trees stay in its task, so the average is taken before anything moves. ``key`` must tell rows apart.
    """
    settings = lake.read("ai", SETTINGS).orderBy("feature").collect()
    sample, trees = settings[0].sample, settings[0].trees
    fill = {r.name: r.fill for r in settings if r.fill is not None}
    points = with_any_feature(df, [r.name for r in settings]).select(key, F.array(*filled([r.name for r in settings], fill)).alias("point"))
    # Dealt by key once, while a row is one row; the average by key then moves nothing.
    points = points.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    inner = F.col("feature") >= 0
    size, depth = F.col("size").cast("double"), F.col("depth")
    correction = F.when(size <= 1, 0.0).when(size == 2, 1.0).otherwise(2 * (F.log(size - 1) + float(np.euler_gamma)) - 2 * (size - 1) / size)
    nodes = lake.read("ai", NODES).select(
        "tree_id",
        "node_id",
        F.when(inner, F.col("feature")).otherwise(0).alias("feature"),
        F.when(inner, F.col("split")).otherwise(float("inf")).alias("split"),  # a row in its leaf stays there
        F.when(inner, F.col("left_node")).otherwise(F.col("node_id")).alias("left"),
        F.when(~inner, depth + correction).alias("path"),
    )
    # The nodes of a tree are numbered from 0 without gaps, so a node's number is its place.
    listed = F.array_sort(F.collect_list(F.struct("node_id", "feature", "split", "left", "path")))
    forest = nodes.groupBy("tree_id").agg(listed.alias("n")).select(*[F.col(f"n.{c}").alias(c) for c in ("feature", "split", "left", "path")])
    place = points.crossJoin(F.broadcast(forest)).withColumn("node", F.lit(0))
    for _ in range(math.ceil(math.log2(max(sample, 2)))):
        right = F.get("point", F.get("feature", F.col("node"))) > F.get("split", F.col("node"))
        place = place.withColumn("node", F.get("left", F.col("node")) + right.cast("int"))
    ended = place.select(key, F.get("path", F.col("node")).alias("path"))
    return ended.groupBy(key).agg((F.sum("path") / trees).alias("mean_path"))


def threshold(scores: DataFrame, column: str, contamination: float, exact: bool = True) -> float:
    """Score below which the given share of rows lies (linear interpolation)."""
    find = exact_quantiles if exact else approx_quantiles
    value = find(scores.select(column), {column: contamination})[column]
    return 0.0 if value is None else value


def detect(
    df: DataFrame,
    features: list[str],
    contamination: float = CONTAMINATION,
    exact: bool = True,
    forest: Forest | None = None,
    location: str | None = None,
    identity: list[str] | None = None,
) -> DataFrame:
    """Usable rows with ``anomaly_score`` (negative = anomalous) and ``is_anomaly``.

    ``identity`` names the columns that tell rows apart when the forest is fitted, such as the key.
    Scoring is the costly step and both the threshold and the result need it, so the scored rows are
    written once to ``location`` (by default a new folder of the shared scratch area). The threshold
    then reads a single column of that table.
    """
    smallest, largest = CONTAMINATION_RANGE
    if not smallest <= contamination <= largest:
        raise ValueError(f"contamination must lie in [{smallest}, {largest}]")
    spark = df.sparkSession
    model = forest or fit(df, features, exact=exact, identity=identity)
    usable = with_any_feature(df, features)
    path = location or scratch_dir(spark, "scores")
    usable.withColumn("raw_score", model.score(spark)).write.parquet(path)
    scored = spark.read.parquet(path)
    offset = threshold(scored, "raw_score", contamination, exact)
    return (
        scored.withColumn("anomaly_score", F.col("raw_score") - F.lit(offset))
        .withColumn("is_anomaly", F.col("anomaly_score") < 0)
        .drop("raw_score")
    )


def ranked(detected: DataFrame, key: str) -> DataFrame:
    """Flagged rows, most anomalous first."""
    return detected.filter("is_anomaly").orderBy("anomaly_score", key)
