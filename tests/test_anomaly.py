from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import looks_like_id, recommended_features
from ledgerloom.operators import features, incidents, isolation_forest
from tests.conftest import values

NAMES = ["amount", "quantity"]


@pytest.fixture(scope="module")
def planted(spark):
    """A thousand ordinary rows and ten far outliers."""
    random = np.random.default_rng(3)
    ordinary = [(f"n{i:04d}", float(a), float(q)) for i, (a, q) in enumerate(random.normal([100, 10], [10, 2], (1000, 2)))]
    far = [(f"out{i}", 900.0 + 50 * i, 80.0 + i) for i in range(10)]
    return spark.createDataFrame(ordinary + far, "id string, amount double, quantity double").repartition(4).cache()


@pytest.fixture(scope="module")
def found(planted):
    return isolation_forest.detect(planted, NAMES).cache()


def test_feature_choice(spark):
    df = spark.createDataFrame([], "transaction_id bigint, date_key int, paid_amount decimal(18,2), note string, fee double, tax float, rate double")
    assert recommended_features(df) == ["paid_amount", "fee", "tax"]
    assert recommended_features(df, legacy_substring=True) == ["fee", "tax", "rate"]
    assert recommended_features(df.select("transaction_id", "date_key", "note")) == ["transaction_id", "date_key"]
    assert looks_like_id("paid", True) and not looks_like_id("paid")


def test_feature_preparation(spark):
    rows = [(i, float(i), 1.0, None) for i in range(9)]
    rows += [(9, float("inf"), 5.0, None), (10, float("nan"), None, None), (11, None, float("-inf"), None), (12, None, 7.0, None)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    ready = features.prepare(df, ["a", "b", "c"], ["id"])
    assert {r.id: (r.a, r.b, r.c) for r in ready.collect()} == {
        **{i: (float(i), 1.0, 0.0) for i in range(9)}, 9: (4.0, 5.0, 0.0), 12: (4.0, 7.0, 0.0)
    }


def test_text_features_are_coerced(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(10)] + [(10, "n/a"), (11, None)], "id int, a string")
    ready = {r.id: r.a for r in features.prepare(df, ["a"], ["id"]).collect()}
    assert ready[10] == 4.5 and 11 not in ready


def test_too_few_rows(spark):
    df = spark.range(9).selectExpr("id", "double(id) as a")
    with pytest.raises(features.TooFewRows):
        features.prepare(df, ["a"], ["id"])
    with pytest.raises(features.TooFewRows):
        isolation_forest.detect(df, ["a"])
    with pytest.raises(features.TooFewRows):
        features.require_rows(df.limit(0))
    features.require_rows(df, 9)


def test_path_correction():
    assert isolation_forest.path_correction(np.array([0, 1, 2])).tolist() == [0.0, 0.0, 1.0]
    harmonic = math.log(255) + np.euler_gamma
    assert float(isolation_forest.path_correction(256)) == pytest.approx(2 * harmonic - 2 * 255 / 256)


def test_tree_shape():
    points = np.random.default_rng(0).random((256, 3))
    tree = isolation_forest.grow_tree(points, 5, 42, 8)
    leaves = tree[tree.feature < 0]
    assert leaves["size"].sum() == 256 and tree.depth.max() <= 8
    assert len(tree) == 2 * len(leaves) - 1
    assert sorted(tree.node_id) == list(range(len(tree)))
    inner = tree[tree.feature >= 0]
    sizes = tree.set_index("node_id")["size"]
    assert (sizes[inner.left_node].to_numpy() + sizes[inner.right_node].to_numpy() == inner["size"].to_numpy()).all()
    constant = isolation_forest.grow_tree(np.ones((50, 2)), 0, 42, 8)
    assert len(constant) == 1 and constant["size"][0] == 50


def test_paths_equal_a_walk_of_the_node_table(planted, spark):
    forest = isolation_forest.fit(planted, NAMES, trees=7)
    nodes = isolation_forest.fit_nodes(planted, NAMES, 1010, trees=7).toPandas().set_index(["tree_id", "node_id"])
    points = planted.orderBy("id").limit(40).toPandas()[NAMES].to_numpy()

    def walk(point, tree):
        node = nodes.loc[tree, 0]
        while node.feature >= 0:
            side = node.left_node if point[int(node.feature)] <= node.split else node.right_node
            node = nodes.loc[tree, int(side)]
        return node.depth + float(isolation_forest.path_correction(node["size"]))

    expected = [np.mean([walk(point, tree) for tree in range(7)]) for point in points]
    assert forest.mean_path(points) == pytest.approx(expected)


def test_model_is_the_same_for_any_partitioning(planted):
    tables = [
        values(isolation_forest.fit_nodes(planted.repartition(n), NAMES, 1010, trees=20)) for n in (1, 3, 9)
    ]
    assert tables[0] == tables[1] == tables[2]
    roots = [row for row in tables[0] if row[1] == 0]
    assert len(roots) == 20 and all(root[6] == 256 for root in roots)


@pytest.mark.parametrize("rows", [200, 5000, 200_000])
def test_every_tree_gets_a_full_sample(spark, rows):
    df = spark.range(rows).selectExpr("id", "double(id) as a")
    roots = isolation_forest.fit_nodes(df, ["a"], rows).filter("node_id = 0")
    assert values(roots.groupBy("size").count()) == [(min(rows, 256), 200)]


def test_only_identity_and_features_are_read(planted, tmp_path, spark):
    path = str(tmp_path / "wide")
    planted.withColumn("note", F.repeat(F.lit("x"), 50)).write.parquet(path)
    wide = spark.read.parquet(path)
    with_key = isolation_forest.fit(wide, NAMES, trees=5, identity=["id"])
    plain = isolation_forest.fit(planted.select("id", *NAMES), NAMES, trees=5, identity=["id"])
    assert (with_key.split == plain.split).all()
    samples = isolation_forest.tree_samples(wide.select("id", *NAMES), NAMES, 10_000, 5, 256, 42)
    assert samples.columns == ["tree_id", "row_hash", *NAMES, "copies"]


@pytest.mark.parametrize("rows", [3_000, 2_000_000])
def test_repeated_rows_give_whole_trees(spark, rows):
    """550 different rows, however many there are: every tree has a full sample of many of them."""
    df = spark.range(rows).selectExpr("double(id % 55) as a", "double(id % 10) as b")
    nodes = isolation_forest.fit_nodes(df, ["a", "b"], rows)
    roots = nodes.filter("node_id = 0")
    assert values(roots.groupBy("size").count()) == [(256, 200)]
    assert nodes.groupBy("tree_id").count().agg(F.min("count")).first()[0] > 60


def test_forest_of_repeated_rows_does_not_depend_on_partitions_and_finds_the_outlier(spark):
    df = spark.range(40_000).selectExpr("double(id % 55) as a", "double(id % 10) as b")
    df = df.unionAll(spark.createDataFrame([(500.0, 90.0)] * 3, df.schema))
    forests = [isolation_forest.fit(df.repartition(n), ["a", "b"]) for n in (1, 64)]
    assert (forests[0].split == forests[1].split).all() and (forests[0].path == forests[1].path).all()
    found = isolation_forest.detect(df, ["a", "b"], forest=forests[0])
    assert {(r.a, r.b) for r in found.orderBy("anomaly_score").limit(3).collect()} == {(500.0, 90.0)}


def test_draws_of_a_row_go_to_different_trees(spark):
    df = spark.range(300).selectExpr("id", "double(id) as a")
    samples = isolation_forest.tree_samples(df, ["a"], 300, 200, 256, 42, ["id"])
    assert values(samples.groupBy("tree_id").agg(F.count("*"), F.max("copies")).selectExpr("`count(1)`", "`max(copies)`").distinct()) == [(300, 1)]


def test_an_identity_that_repeats_is_refused(spark):
    df = spark.range(1_000_000).selectExpr("id % 3 as id", "1.0D as a", "double(id % 3) as b")
    with pytest.raises(ValueError, match="tell rows apart"):
        isolation_forest.fit(df, ["a", "b"], identity=["id"])


def test_planted_outliers_rank_first(found):
    top = isolation_forest.ranked(found, "id").limit(10).collect()
    assert {r.id for r in top} == {f"out{i}" for i in range(10)}


def test_flagged_share_and_threshold(found):
    assert found.count() == 1010
    flagged = found.filter("is_anomaly").count()
    assert flagged == pytest.approx(0.05 * 1010, abs=1)
    assert found.filter("is_anomaly != (anomaly_score < 0)").count() == 0


def test_scores_do_not_depend_on_partitions(planted):
    forest = isolation_forest.fit(planted, NAMES, trees=20)
    one = isolation_forest.detect(planted.coalesce(1), NAMES, forest=forest)
    many = isolation_forest.detect(planted.repartition(8), NAMES, forest=forest)
    assert values(one) == values(many)


def test_contamination_is_checked(planted):
    with pytest.raises(ValueError):
        isolation_forest.detect(planted, NAMES, contamination=0.5)


def test_baseline_of_normal_rows(spark):
    rows = [("a", 1.0, 5.0, None, False), ("b", 2.0, None, None, False), ("c", 4.0, None, None, False), ("d", 1e9, 1e9, 1.0, True)]
    df = spark.createDataFrame(rows, "id string, x double, y double, z double, is_anomaly boolean")
    base = incidents.baseline(df, ["x", "y", "z"])
    assert base == {"x": (2.33, 2.0, 1.53), "y": (5.0, 5.0, 0.0)}
    assert incidents.measured_columns(df.withColumn("anomaly_score", F.lit(0.5))) == ["x", "y", "z"]


def test_context_deviation_and_incident(spark):
    df = spark.createDataFrame(
        [("d", 10.0, 7.0, None, True, -0.123456), ("e", None, 5.0, 1.0, True, None)],
        "id string, x double, y double, z double, is_anomaly boolean, anomaly_score double",
    )
    base = {"x": (2.0, 2.0, 2.0), "y": (5.0, 5.0, 0.0)}
    contexts = incidents.context(df, ["x", "y", "z"], base, ["x", "y"])
    first = json.loads(incidents.context_json(contexts.filter("flagged_row.id = 'd'")).first().context)
    assert first["dimension"] == "Transaction anomaly based on: x, y"
    assert first["anomaly_score"] == -0.1235
    assert first["flagged_values"] == {"x": 10.0, "y": 7.0, "z": None}
    assert first["baseline_from_normal_data"]["x"] == {"mean": 2.0, "median": 2.0, "std": 2.0}
    assert first["flagged_row"]["z"] is None
    assert contexts.filter("flagged_row.id = 'e'").first().anomaly_score == 0.0
    found = {(r.id, r.column_name): r.deviation for r in incidents.deviations(df, "id", base).collect()}
    assert found == {("d", "x"): 4.0, ("d", "y"): None, ("e", "x"): None, ("e", "y"): None}
    table = {r.affected_record: r for r in incidents.incident_table(df, "id", base).collect()}
    assert table["d"].why_anomalous == "x lies 4.00 standard deviations above the normal mean."
    assert table["d"].possible_impact == "Values far from normal: x"
    assert table["e"].why_anomalous.startswith("The evidence is weak")


def test_stored_forest_scores_the_same_in_both_ways(spark, lake):
    """Loaded from its tables, by Arrow batches and by joins, with gaps filled and rows without features left out."""
    rng = np.random.default_rng(3)
    rows = [(f"t{i}", float(a) if i % 7 else None, float(b), "x") for i, (a, b) in enumerate(rng.standard_normal((500, 2)))]
    df = spark.createDataFrame([*rows, ("none", None, None, "x")], "k string, a double, b double, place string")
    fitted = isolation_forest.fit_stored(lake, df, ["a", "b"], trees=20, sample=64, identity=["k"])
    loaded = isolation_forest.load_forest(lake)
    assert loaded.features == fitted.features and loaded.fill == fitted.fill and "a" in loaded.fill
    plain = isolation_forest.fit(df, ["a", "b"], trees=20, sample=64, identity=["k"])
    assert (plain.split == loaded.split).all() and (plain.path == loaded.path).all()
    found = {r.k: r.mean_path for r in isolation_forest.mean_paths_by_joins(df, lake, "k").collect()}
    points = np.array([[loaded.fill["a"] if a is None else a, b] for _, a, b, _ in rows])
    assert set(found) == {r[0] for r in rows}
    assert np.allclose([found[r[0]] for r in rows], loaded.mean_path(points), rtol=1e-12)
    lake.replace("ai", isolation_forest.NODES, lake.read("ai", isolation_forest.NODES).filter("tree_id <> 3"))
    with pytest.raises(ValueError, match="19 of 20 trees"):
        isolation_forest.load_forest(lake)


def test_trees_are_walked_within_a_row(spark, lake):
    """One join with the trees; a join for each level met every row once a tree each time."""
    rows = [(f"t{i}", float(i % 17), float(i % 23)) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    forest = isolation_forest.fit_stored(lake, df, ["a", "b"], trees=8, sample=32, identity=["k"])
    paths = isolation_forest.mean_paths_by_joins(df, lake, "k")
    plan = paths._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Generate" not in plan
    found = {r.k: r.mean_path for r in paths.collect()}
    assert np.allclose([found[r[0]] for r in rows], forest.mean_path(np.array([r[1:] for r in rows])), rtol=1e-12)
