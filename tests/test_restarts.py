"""k-means restarts against plain NumPy."""

import numpy as np
import pytest

from wideframe.operators import restarts as R


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.6, (80, 2)) for c in ((0, 0), (4, 0), (0, 5), (5, 5))])
    x = np.concatenate([x, np.repeat(x[:1], 60, axis=0)])  # one very common row
    return x, spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, `b c` double").repartition(5)


def inertia(x, c):
    return ((x[:, None, :] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_every_start_is_a_fixed_point_and_the_best_comes_first(points):
    x, df = points
    starts = R.fit_restarts(df, ["a", "b c"], k=4, starts=6, tolerance=0.0)
    assert [s.inertia for s in starts] == sorted(s.inertia for s in starts)
    for s in starts:
        at, _ = R.nearest(x, s.centres)
        assert s.inertia == pytest.approx(inertia(x, s.centres))
        assert s.centres == pytest.approx(np.stack([x[at == k].mean(axis=0) for k in range(4)]))
    assert starts[0].inertia <= inertia(x, np.array([(0, 0), (4, 0), (0, 5), (5, 5)]))


def test_starts_together_equal_starts_alone(points, spark):
    x, df = points
    three = {tuple(map(tuple, s.centres.round(9))) for s in R.fit_restarts(df, ["a", "b c"], k=3, starts=3, seed=7)}
    alone = {tuple(map(tuple, R.fit_restarts(df.repartition(2), ["a", "b c"], k=3, starts=1, seed=7 + s)[0].centres.round(9))) for s in range(3)}
    assert three == alone


def test_odd_tables(spark):
    one = spark.createDataFrame([(1.0,)] * 5, "a double")
    s = R.fit_restarts(one, ["a"], k=2, starts=2)[0]
    assert s.centres.tolist() == [[1.0]] and s.inertia == 0
    assert R.fit_restarts(one.limit(0), ["a"], k=2) == []
    with pytest.raises(Exception, match="missing"):
        R.fit_restarts(spark.createDataFrame([(1.0,), (None,)], "a double"), ["a"], k=1)
