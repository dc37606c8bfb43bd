"""Steps whose cost per task must not grow with the table."""
import io
from contextlib import redirect_stdout

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wideframe import session
from wideframe.operators import scale
from wideframe.plans import player


def _tables(spark, path, orders):
    o = spark.range(1, orders + 1)
    o.select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"),
             F.lit("O").alias("o_orderstatus"), (F.col("id") * 10.0).alias("o_totalprice")).write.parquet(f"{path}/orders.parquet")
    spark.range(7).select(F.col("id").alias("c_custkey"), F.lit(1.5).alias("c_acctbal")).write.parquet(f"{path}/customer.parquet")
    o.crossJoin(spark.range(1, 5).withColumnRenamed("id", "l")).select(
        F.col("id").alias("l_orderkey"), F.col("l").cast("int").alias("l_linenumber"), F.lit(9.0).alias("l_quantity"),
        F.lit(100.0).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.02).alias("l_tax")).write.parquet(f"{path}/lineitem.parquet")


def test_player_table_shuffles_grow_with_the_lineitem_rows(spark, tmp_path, monkeypatch):
    _tables(spark, str(tmp_path), 100)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(player, "ROWS_PER_TASK", 10)
    assert player.player_table(spark, str(tmp_path)).count() == 100
    assert session.shuffle_partitions(spark) == max(own, 40)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == own
    monkeypatch.setattr(player, "ROWS_PER_TASK", 1_000_000)
    player.player_table(spark, str(tmp_path))
    assert session.shuffle_partitions(spark) == own


def test_quantile_transform_searches_its_quantiles_by_halving(spark):
    qs = sorted([float(v) for v in np.random.default_rng(1).normal(size=997)] + [0.25, 0.25, 0.25])
    refs = [i / 999 for i in range(1000)]
    x = [*np.random.default_rng(2).normal(size=300).tolist(), 0.25, qs[0], qs[-1], qs[500], -9.0, 9.0]
    df = spark.createDataFrame([(v,) for v in x] + [(None,)], "x double")
    out = scale.QuantileNormalModel({"x": qs}, refs, "uniform").transform(df.withColumn("x0", F.col("x")))
    told = {r["x0"]: r["x"] for r in out.collect()}
    assert told.pop(None) is None
    np.testing.assert_allclose([told[v] for v in x], scale.uniform_from_quantiles(np.array(x), np.array(qs), np.array(refs)), atol=1e-12)
    with redirect_stdout(io.StringIO()) as text:
        out.explain()
    assert "512,256,128" in text.getvalue().replace(" ", "")


def test_wide_queries_set_the_method_limit(spark, tmp_path):
    _tables(spark, str(tmp_path), 3)
    spark.conf.unset(session.METHOD_LIMIT)
    entry.queries()["player_table"](spark, str(tmp_path)).collect()
    assert spark.conf.get(session.METHOD_LIMIT) == "8000"
    spark.conf.unset(session.METHOD_LIMIT)


def test_tree_levels_are_walked_over_whole_columns_of_bytes():
    from wideframe.operators import histboost as HB

    class Columns(np.ndarray):
        def __getitem__(self, i):
            assert not isinstance(i, tuple)  # one gather per row and level
            return np.asarray(self)[i]

    rng = np.random.default_rng(3)
    plain = rng.integers(0, 129, size=(4, 500)).astype(np.uint8)
    for depth in range(1, 10):
        levels = [(rng.integers(0, 4, 1 << d).tolist(), rng.choice([10, 64, 128, 255], 1 << d).tolist()) for d in range(depth)]
        want = np.zeros(500, dtype=np.int64)
        for features, limits in levels:
            want = 2 * want + (plain[np.asarray(features)[want], np.arange(500)] > np.asarray(limits)[want])
        bins = plain.view(Columns) if depth <= 6 else plain
        got = HB.nodes(bins, levels)
        assert got.dtype == np.int64 and (got == want).all()
        assert (HB.nodes(bins, levels[-1:], HB.nodes(bins, levels[:-1])) == want).all()


def test_restart_distances_run_over_contiguous_columns():
    import pyarrow as pa

    from wideframe.operators import restarts as RS

    x = np.random.default_rng(4).integers(0, 3, size=(200, 3)).astype(float)
    m = RS._matrix(pa.record_batch([pa.array(c) for c in x.T], names=["a", "b", "c"]))
    assert m.shape == (200, 3) and m[:, 0].flags.c_contiguous
    centres = np.array([[0.0, 1.0, 2.0], [2.0, 1.0, 0.0], [1.0, 1.0, 1.0]])
    d = ((x[:, None, :] - centres) ** 2).sum(axis=2)
    at, least = RS.nearest(m, centres)
    assert (at == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()


def test_leaf_contributions_are_tabulated_per_feature():
    from wideframe.operators import explain as EX

    tree = EX.Tree(*(np.array(v) for v in ([1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0, -1, 1, -1, -1], [0.5, 0, 1.5, 0, 0],
                                           [0.0, 1.0, 0.0, 2.0, 5.0], [10.0, 4.0, 6.0, 3.0, 3.0])))
    leaves = EX.leaves_of(tree)
    assert {leaf.table.shape for leaf in leaves} == {(1, 2), (2, 4)}
    assert all(row.flags.c_contiguous for leaf in leaves for row in leaf.table)
    x = np.array([[0.0, 0.0], [1.0, 1.0], [1.0, 2.0], [np.nan, 1.0]])
    phi = EX.tree_shap(x, [tree], [leaves])
    np.testing.assert_allclose(phi[:3].sum(axis=1) + EX.expected_value([tree]), [1.0, 2.0, 5.0])


def test_forest_keeps_the_nodes_of_its_rows(spark):
    from wideframe.operators import models as M

    assert M.make_estimator("random_forest", "y").getCacheNodeIds()


def test_wide_queries_read_small_file_pieces(spark, tmp_path):
    _tables(spark, str(tmp_path), 3)
    spark.conf.set(session.FILE_SPLIT, "128m")
    entry.queries()["player_table"](spark, str(tmp_path)).collect()
    assert spark.conf.get(session.FILE_SPLIT) == "16m"
    entry._configure(spark, wide=False)  # the other queries keep the session's own number
    assert spark.conf.get(session.FILE_SPLIT) == spark.sparkContext.getConf().get(session.FILE_SPLIT, "134217728b")


def test_export_cleans_the_table_once(spark, tmp_path, monkeypatch):
    from wideframe.operators import impute

    _tables(spark, str(tmp_path), 20)
    fits, fit = [], impute.MedianImputer.fit
    monkeypatch.setattr(impute.MedianImputer, "fit", lambda self, df: fits.append(self.cols) or fit(self, df))
    rows = {r["name"]: r["rows"] for r in entry.queries()["export_outputs"](spark, str(tmp_path)).collect()}
    assert rows == {"clean": 20, "scaled": 20, "target_summary": 3, "correlations": 4, "imputer_params": len(fits[0]) - 1}
    assert len(fits) == 1


def test_contributions_are_ranked_without_lambdas(spark):
    from wideframe.operators import select as SEL

    nan = float("nan")
    rows = [(1, 2.0, -2.0, nan, None), (2, None, None, None, None), (3, nan, 0.0, nan, -0.0), (4, 1.0, -5.0, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "player_id long, b double, a double, d double, c double")
    values = {"T1": {c: c for c in "bad"}, "T2": {c: f"{c} * 2" for c in "cb"}}
    want = set()
    for i, *x in rows:
        at = dict(zip("badc", x))
        for t, exprs in values.items():
            have = {f: at[f] * (1 if t == "T1" else 2) for f in exprs if at[f] is not None}
            order = sorted(have, key=lambda f: (have[f] != have[f], 0 if have[f] != have[f] else -abs(have[f]), f))
            want |= {(i, t, f, repr(abs(have[f])), n + 1) for n, f in enumerate(order[:2])}
    out = SEL.top_contributions(df, values, 2)
    assert {(r["player_id"], r["target"], r["feature"], repr(abs(r["value"])), r["rank"]) for r in out.collect()} == want
    with redirect_stdout(io.StringIO()) as text:
        out.explain()
    assert "lambda" not in text.getvalue()


def test_lines_are_dealt_before_they_are_grouped(spark):
    """The task that reads a file piece holds no table of orders."""
    rows = [(i % 5, i % 7 + 1, float(i), 10.0 * i, 0.25, 0.5) for i in range(40)] + [(None, 1, 1.0, 1.0, 0.0, 0.0)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                        "l_discount double, l_tax double")
    wide = player.lineitem_wide(lines)
    plan = wide._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(plan) if "Exchange" in line)
    assert not any("Aggregate" in line for line in plan[dealt:])
    got = {r["k"]: (r["Target1"], r["Target3"], r["T01"]) for r in wide.collect()}
    for k in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == k]
        first = [r[3] / 1000 for r in mine if r[1] == 1]
        assert got[k] == (sum(r[2] for r in mine), sum(r[3] * (1 - r[4]) for r in mine) / 1000, max(first, default=None))


def test_tree_fits_pass_over_few_partitions(spark, monkeypatch):
    """A level of a tree is a pass; its tasks are few, however the table lies."""
    from pyspark.ml import Pipeline

    from wideframe.operators import models as M

    rng = np.random.default_rng(6)
    rows = [(float(a), float(b), None if i % 9 == 0 else float(a + b)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(64).persist()
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, data: seen.append((data.rdd.getNumPartitions(), data.count())) or fit(self, data))
    M.fit_pipeline(df, ["a", "b"], "y", "gbt", maxIter=2, maxDepth=2)
    M.fit_pipeline(df.coalesce(8), ["a", "b"], "y", "random_forest", numTrees=2, maxDepth=2)
    labelled = sum(r[2] is not None for r in rows)
    assert seen == [(4, labelled), (8, labelled)]
    monkeypatch.setattr(M, "FIT_ROWS", 20)
    assert M.packed(df).rdd.getNumPartitions() == 15
    df.unpersist()


def test_folds_are_fitted_and_scored_over_few_partitions(spark, monkeypatch):
    from pyspark.ml import PipelineModel

    from wideframe.operators import models as M

    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, float(a), float(a + b)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))], "id long, a double, y double")
    df = df.repartition(64).persist()
    seen, transform = [], PipelineModel.transform
    monkeypatch.setattr(PipelineModel, "transform", lambda self, data: seen.append(data.rdd.getNumPartitions()) or transform(self, data))
    r = M.kfold_metrics(df, ["a"], "y", "id", "random_forest", k=3, numTrees=2, maxDepth=2)
    assert seen == [4, 4, 4] and r["n"] == 200
    df.unpersist()


def test_ensemble_members_are_fitted_side_by_side_in_order(spark):
    import threading

    from wideframe.operators import models as M

    meet = threading.Barrier(3, timeout=60)
    assert M.together(spark, [lambda i=i: (meet.wait(), i)[1] for i in range(3)]) == [0, 1, 2]
