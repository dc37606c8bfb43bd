import numpy as np
import pytest
from pyspark.sql import functions as F

from wideframe.operators.crossmoments import corr_tiles


def pearson(x, y):
    ok = ~np.isnan(x) & ~np.isnan(y)
    x, y = x[ok], y[ok]
    if len(x) < 2 or x.std() == 0 or y.std() == 0:
        return None
    return float(np.corrcoef(x, y)[0, 1])


@pytest.mark.parametrize("tile, cells", [(256, 50_000_000), (3, 100)])
def test_pairs_equal_numpy(spark, tile, cells):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 8)) + np.array([0, 1e6, 0, 0, 5, 0, 0, 0])
    x[:, 3] = x[:, 0] * 2 + 0.1 * x[:, 2]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 5], x[:, 6] = 7.25, np.nan
    rows = [tuple(None if np.isnan(v) and j % 2 else float(v) for j, v in enumerate(r)) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"`f {i}` double" for i in range(8))).repartition(3)
    got = {(r.row_feature, r.col_feature): r["corr"] for r in corr_tiles(df, df.columns, tile, cells).collect()}
    assert len(got) == 64
    for i in range(8):
        for j in range(8):
            want = pearson(x[:, i], x[:, j])
            assert got[f"f {i}", f"f {j}"] == (None if want is None else pytest.approx(want, abs=1e-9))
    assert corr_tiles(df.limit(0), df.columns).count() == 0


def test_two_thousand_columns_in_one_scan(spark):
    k = 2000
    df = spark.range(40).select(*[((F.col("id") * (i + 3)) % 17).cast("double").alias(f"c{i}") for i in range(k)])
    out = corr_tiles(df, df.columns)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert out.count() == k * k
