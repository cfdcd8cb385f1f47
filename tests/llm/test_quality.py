from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import quality


@pytest.fixture(scope="module")
def sf(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return docs.withColumnsRenamed({"source": "host", "lang": "path"}), labels


def test_held_out_accuracy(sf):
    docs, labels = sf
    found = quality.score(docs, labels).join(labels, "doc_id").filter("held_out").select("keep", "quality", "toxic").collect()
    right = np.array([r.keep == (r.quality == 1) for r in found])
    assert len(right) > 500 and right.mean() > 0.97
    good = [r.keep for r in found if r.quality == 1]
    assert np.mean(good) > 0.98


def prose(i):
    return f"calm words number {i} in a line of prose about things that {i % 7} people said"


@pytest.fixture(scope="module")
def sites(spark):
    rows, labels = [], []
    for i in range(600):
        host = "good" if i % 2 else "bad"
        rows.append((i, prose(i), host, f"{host}/{i % 4 // 2}"))
        labels.append((i, int(i % 2 or i % 10 == 0), None))
    rows.append((9000, prose(1), "bad", "bad/rare"))
    rows.append((9001, prose(1), "unseen", "unseen/x"))
    return spark.createDataFrame(rows, "doc_id long, text string, host string, path string").repartition(5), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_sites_shrink_towards_their_parents(sites):
    docs, labels = sites
    found = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    total = np.mean([r.host_mean for r in found.values()])
    bad, good = found[0], found[1]
    assert bad.host_mean < 0.35 < total < 0.8 < good.host_mean
    assert bad.score < good.score and not bad.keep and good.keep
    # A path with one document says what its host says, a host with one document what all say.
    assert found[9000].path_mean == pytest.approx(found[9000].host_mean, abs=1e-9)
    assert abs(found[9001].host_mean - total) < 0.15


def test_posteriors_against_plain_sums(sites):
    docs, labels = sites
    found = quality.score(docs, labels).join(docs.select("doc_id", "host", "path"), "doc_id").toPandas()
    given = labels.toPandas().set_index("doc_id")["quality"]
    found["good"] = [given[d] if d in given.index and not h else c for d, h, c in zip(found["doc_id"], found["held_out"], found["classifier"], strict=True)]
    mean = found["good"].mean()
    by_host = found.groupby("host")["good"].agg(["sum", "count"])
    spread = (by_host["count"] * (by_host["sum"] / by_host["count"] - mean) ** 2 - mean * (1 - mean)).sum() / len(found)
    firm = min(max(mean * (1 - mean) / spread - 1, 1), 1e6)
    for r in found.itertuples():
        host = by_host.loc[r.host]
        assert r.host_mean == pytest.approx((host["sum"] - r.good + firm * mean) / (host["count"] - 1 + firm), abs=1e-9)


def test_edge_rows(spark, clashing):
    rows = [(1, None, "h", "p"), (2, "", None, None), (None, prose(2), "h", None), (3, prose(3), None, "p"), (3, prose(3), None, "p"), (4, "word " * 50_000, "h", "p")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, host string, path string"), "n", "good", "chance", "label", "score")
    labels = clashing(spark.createDataFrame([(3, 1), (3, 0), (4, None), (None, 1)], "doc_id long, quality int"), "host", "text")
    found = quality.score(docs, labels).collect()
    assert sorted(r.doc_id or 0 for r in found) == [0, 1, 2, 3, 3, 4]
    assert all(0 <= r.score <= 1 and 0 <= r.path_mean <= 1 for r in found)
    without = quality.score(docs, labels.limit(0)).collect()
    assert len(without) == 6 and all(r.classifier == 0.5 for r in without)
    assert quality.score(docs.limit(0), labels).collect() == []


def test_partitions_do_not_matter(sites):
    docs, labels = sites
    one = sorted((r.doc_id, round(r.score, 12)) for r in quality.score(docs, labels).collect())
    two = sorted((r.doc_id, round(r.score, 12)) for r in quality.score(docs.repartition(1), labels.repartition(3)).collect())
    assert one == two


def test_fit_is_the_maximum():
    random = np.random.default_rng(0)
    rows = np.c_[random.normal(size=(400, 3)), np.ones(400)]
    good = (rows @ [2, -1, 0, 0.5] + random.logistic(size=400) > 0).astype(float)
    model = quality.fit(rows, good)
    x = (rows - model.center) / model.scale
    assert np.allclose(x.T @ (good - model.chance(rows)) - model.weights, 0, atol=1e-6)


def test_the_sample_is_bounded_whatever_repeats(spark, sites, monkeypatch):
    docs, labels = sites
    hot = spark.range(5000).selectExpr("1L AS doc_id", "concat(repeat('word ', id % 900), id) AS text", "'good' AS host", "'good/0' AS path")
    same = spark.range(5000).selectExpr("2L AS doc_id", "'one row' AS text", "'bad' AS host", "'bad/1' AS path")
    sizes, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, good: (sizes.append(len(rows)), fit(rows, good))[1])
    found = quality.score(docs.unionByName(hot).unionByName(same), labels, max_rows=100)
    assert found.count() == docs.count() + 10_000 and 0 < sizes[0] <= 100
