from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.functions.quantiles import approx_quantiles, exact_quantiles
from ledgerloom.operators import incidents

PROBABILITIES = [0.0, 0.05, 0.5, 0.93, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12) | st.integers(0, 3).map(float), min_size=1, max_size=60), st.sampled_from(PROBABILITIES))
def test_small_columns(spark, values, p):
    found = exact_quantiles(frame(spark, values), {"v": p})["v"]
    assert found == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("p", PROBABILITIES)
def test_many_passes(spark, p):
    """Few bins and a tiny window force several passes, over values of very different size."""
    random = np.random.default_rng(1)
    parts = [random.normal(size=4000), np.full(2000, 0.25), random.lognormal(8, 3, size=500), [1e300, -1e300, 5e-324, 1e-200]]
    values = np.concatenate(parts)
    found = exact_quantiles(frame(spark, values), {"v": p}, bins=16, window=25)["v"]
    assert found == pytest.approx(np.quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("sign", [1, -1])
def test_values_of_one_sign(spark, sign):
    values = sign * np.random.default_rng(2).lognormal(0, 40, size=3000)
    found = exact_quantiles(frame(spark, values), {"v": 0.37}, bins=8, window=10)["v"]
    assert found == pytest.approx(np.quantile(values, 0.37), rel=1e-12)


def test_two_hot_values(spark):
    values = [1.0] * 500 + [2.0] * 500
    assert exact_quantiles(frame(spark, values), {"v": 0.5}, bins=4, window=10)["v"] == 1.5


def test_neighbouring_doubles(spark):
    values = [1.0] * 30 + [float(np.nextafter(1.0, 2.0))] * 30
    assert exact_quantiles(frame(spark, values), {"v": 0.9}, bins=4, window=10)["v"] == values[-1]


def test_nulls_nan_and_empty(spark):
    rows = [None, float("nan"), float("inf"), 3.0, 5.0]
    assert exact_quantiles(frame(spark, rows), {"v": 0.5}) == {"v": 4.0}
    assert exact_quantiles(frame(spark, [None]), {"v": 0.5}) == {"v": None}
    assert exact_quantiles(frame(spark, [1.0]), {}) == {}


def test_several_columns_at_once(spark):
    df = spark.range(1001).selectExpr("double(id) as a", "double(id * id) as b", "cast(null as double) as c")
    wanted = {"a": 0.5, "b": 0.5, "c": 0.5}
    assert exact_quantiles(df, wanted) == {"a": 500.0, "b": 250000.0, "c": None}
    assert exact_quantiles(df, wanted, bins=8, window=4) == {"a": 500.0, "b": 250000.0, "c": None}


def test_tolerance(spark):
    df = spark.range(100_000).selectExpr("double(id) as a")
    assert approx_quantiles(df, {"a": 0.5}, 0.01)["a"] == pytest.approx(50_000, abs=1000)


def test_kept_sketches_add_up(spark):
    """Any range of days gives what its rows give, for columns of very different mean and spread, and an empty one."""
    random = np.random.default_rng(4)
    days = [int(d) for d in random.integers(0, 40, 6000)]
    near, far = random.normal(1e9, 2.0, 6000).tolist(), random.lognormal(3, 2, 6000).tolist()
    near[5], far[6] = float("nan"), float("inf")
    rows = [(d, a, b if i % 3 else None, None, d % 7 == 0) for i, (d, a, b) in enumerate(zip(days, near, far, strict=True))]
    df = spark.createDataFrame(rows, "day int, a double, b double, c double, odd boolean").repartition(5).cache()
    kept = incidents.baseline_sketches(df, ["a", "b", "c"], "day", flag="odd").cache()
    assert kept.count() == 3 * len({d for d in days if d % 7})
    for first, last in ((0, 39), (9, 10), (12, 12)):
        span = f"day BETWEEN {first} AND {last}"
        expected = incidents.baseline(df.filter(span), ["a", "b", "c"], flag="odd")
        found = incidents.kept_baseline(kept.filter(span), ["a", "b", "c"], df.filter(span), flag="odd")
        assert found == expected and sorted(found) == ["a", "b"]
        for i, c in enumerate("ab", 1):
            own = np.array([r[i] for r in rows if first <= r[0] <= last and not r[4] and r[i] is not None and np.isfinite(r[i])])
            assert found[c] == pytest.approx((own.mean(), np.median(own), own.std(ddof=1)), abs=0.006)
            about = incidents.kept_baseline(kept.filter(span), [c], flag="odd")[c][1]
            assert abs((own < about).mean() - 0.5) < 0.01
    assert incidents.kept_baseline(kept.filter("day > 99"), ["a"]) == {}
