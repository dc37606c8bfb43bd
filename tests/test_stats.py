import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wideframe.operators import profile as PR
from wideframe.operators import quantile as Q
from wideframe.operators import select as SEL
from wideframe.operators.metrics import linear_loo, metric_aggs, overfitting_value


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 600
    a = rng.normal(size=n).round(3)
    b = np.where(np.arange(n) % 3 == 0, 5.0, rng.integers(0, 20, size=n))   # one value holds a third
    c = rng.exponential(size=n)
    rows = [(float(x), float(y), None if i % 7 == 0 else float(z)) for i, (x, y, z) in enumerate(zip(a, b, c))]
    return spark.createDataFrame(rows, "a double, b double, c double"), rows


@pytest.mark.parametrize("method", ["exact"])
def test_quantiles_match_numpy(spark, skewed, method):
    df, rows = skewed
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.37]
    got = Q.quantile_values(df, ["a", "b", "c"], probs, method=method)
    for j, c in enumerate(["a", "b", "c"]):
        vals = np.array([r[j] for r in rows if r[j] is not None])
        want = np.quantile(vals, probs)
        assert np.allclose(got[c], want, rtol=1e-12, atol=1e-12), (c, got[c], want)


def test_quantile_all_null_and_approx(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 4.0), (None, 10.0)], "x double, y double")
    assert Q.medians(df, ["x"], method="exact")["x"] is None
    assert Q.quantile_values(df, ["y"], [0.25], method="exact")["y"] == [1.75]   # interpolated (N6)
    assert Q.quantile_values(df, ["y"], [0.5], method="approx")["y"][0] in (2.0, 4.0)


def test_missing_profile(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (None, None, "b"), (3.0, None, None)], "x double, y double, s string")
    rows = {r["Coluna"]: (r["Missing"], r["Percentual"]) for r in PR.missing_profile(df).collect()}
    assert rows == {"y": (3, 100.0), "x": (1, 33.33), "s": (1, 33.33)}
    assert PR.sparse_columns(df, threshold=70) == ["y"]


def test_guarded_corr_constant_and_pairwise(spark):
    rows = [(1.0, 2.0, 5.0, 1.0), (2.0, 4.1, 5.0, None), (3.0, 5.9, 5.0, 3.0), (4.0, None, 5.0, 4.5)]
    df = spark.createDataFrame(rows, "x double, y double, k double, z double")
    out = {(r["feature"], r["target"]): r["corr"] for r in PR.corr_with_targets(df, ["x", "k", "z"], ["y"]).collect()}
    assert out[("k", "y")] is None                                   # constant → NULL, no ANSI error
    xs, ys = np.array([1.0, 2.0, 3.0]), np.array([2.0, 4.1, 5.9])
    assert math.isclose(out[("x", "y")], np.corrcoef(xs, ys)[0, 1], rel_tol=1e-12)
    zs, yz = np.array([1.0, 3.0]), np.array([2.0, 5.9])               # pairwise complete rows only
    assert math.isclose(out[("z", "y")], np.corrcoef(zs, yz)[0, 1], rel_tol=1e-12)


def test_corr_ranking_ties_by_name(spark):
    rows = [(float(i), float(i), float(i) * 2 + 1, float(i % 3)) for i in range(10)]
    df = spark.createDataFrame(rows, "b double, a double, t double, c double")
    r = SEL.corr_ranking(df, ["b", "a", "c"], "t").orderBy("rank").collect()
    assert [x["feature"] for x in r] == ["a", "b", "c"]


def test_variance_filter_population(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 0.3), (None, 0.0)], "const double, small double")
    # const after zero-fill has variance 2/9 > 0.01 ; small: var_pop([0,.3,0]) = 0.02
    assert SEL.variance_filter(df, ["const", "small"], 0.01) == ["const", "small"]
    assert SEL.variance_filter(df, ["small"], 0.021) == []


def test_describe_and_five_numbers(spark):
    vals = [1.0, 2.0, 4.0, 10.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = PR.describe(df, ["x"]).first()
    assert d["count"] == 5 and d["q25"] == 2.0 and d["q50"] == 4.0 and d["q75"] == 10.0
    assert math.isclose(d["std"], np.std(vals, ddof=1))
    b = PR.five_numbers(df, ["x"]).first()
    assert b["upper_fence"] == 22.0 and b["n_outliers"] == 1 and b["whisker_high"] == 10.0


def test_histogram_counts(spark):
    df = spark.range(100).select((F.col("id") * 1.0).alias("x"))
    h = PR.histogram(df, ["x"], bins=10).collect()
    assert sum(r["count"] for r in h) == 100 and len(h) == 10


def test_regression_metrics_numpy(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(10, 3, 50)
    p = y + rng.normal(0, 1, 50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    m = df.agg(*metric_aggs("y", "p")).first()
    assert math.isclose(m["r2"], 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel_tol=1e-10)
    assert math.isclose(m["mae"], np.abs(y - p).mean(), rel_tol=1e-10)
    assert math.isclose(m["rmse"], np.sqrt(((y - p) ** 2).mean()), rel_tol=1e-10)
    assert math.isclose(m["mape"], np.mean(np.abs((y - p) / np.maximum(np.abs(y), 1e-10))) * 100, rel_tol=1e-10)


def test_overfitting_golden():
    # published target-1 metrics: train 0.732872, test 0.648268 → 11.544 %
    assert round(overfitting_value(0.732872, 0.648268), 3) == 11.544
    assert overfitting_value(-0.1, 0.2) == 0.0


@pytest.mark.parametrize("alpha", [0.0, 2.5])
def test_linear_loo_matches_refits(spark, alpha):
    rng = np.random.default_rng(3)
    n = 25
    X = rng.normal(size=(n, 2))
    y = 1.0 + X @ np.array([2.0, -1.0]) + rng.normal(0, 0.5, n)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)], "x1 double, x2 double, y double")
    got = linear_loo(df, ["x1", "x2"], "y", alpha=alpha)
    errs = []
    for i in range(n):
        m = np.ones(n, bool)
        m[i] = False
        A = np.column_stack([np.ones(m.sum()), X[m]])
        D = np.eye(3)
        D[0, 0] = 0
        beta = np.linalg.solve(A.T @ A + alpha * D, A.T @ y[m])
        errs.append(y[i] - np.r_[1.0, X[i]] @ beta)
    errs = np.array(errs)
    assert math.isclose(got["mae_loo"], np.abs(errs).mean(), rel_tol=1e-8)
    assert math.isclose(got["r2_loo"], 1 - (errs ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel_tol=1e-8)


def test_linear_loo_uses_complete_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=60) + 1e6           # a large offset must not cancel
    y = 2.0 * x + rng.normal(scale=0.1, size=60)
    rows = [(None if i % 4 == 0 else float(x[i]), float(i % 7), None if i % 9 == 0 else float(y[i])) for i in range(60)]
    got = linear_loo(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y")
    full = [r for r in rows if None not in r]
    X = np.array([[1.0, r[0] - 1e6, r[1]] for r in full])
    Y = np.array([r[2] - 2e6 for r in full])
    beta = np.linalg.lstsq(X, Y, rcond=None)[0]
    errs = [Y[i] - X[i] @ np.linalg.lstsq(np.delete(X, i, 0), np.delete(Y, i), rcond=None)[0] for i in range(len(full))]
    assert got["n"] == len(full) and np.allclose(got["coef"], beta[1:], rtol=1e-6)
    assert math.isclose(got["mae_loo"], np.abs(errs).mean(), rel_tol=1e-6)
    assert linear_loo(spark.createDataFrame([], "a double, y double"), ["a"], "y")["r2_loo"] is None
