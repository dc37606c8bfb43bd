import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wideframe.operators import cluster as CL
from wideframe.operators import explain as EX
from wideframe.operators import models as M
from wideframe.operators import select as SEL
from wideframe.operators.encode import OneHotEncoder, bool_to_int, indicators
from wideframe.operators.impute import FillModel, IQROutlierClipper, MedianImputer, ModeImputer
from wideframe.operators.scale import QuantileNormalizer, RobustScaler, StandardScaler, norm_ppf
from wideframe.operators.split import kfold, split_flag, train_test_split


def test_median_imputer_idempotent(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 4.0), (10.0, None)], "a double, b double")
    m = MedianImputer(["a", "b"]).fit(df)
    assert m.values == {"a": 3.0, "b": 3.0}
    once = m.transform(df)
    assert [r["a"] for r in once.collect()] == [1.0, 3.0, 3.0, 10.0]
    again = MedianImputer(["a", "b"]).fit(once)
    assert m.transform(once).collect() == again.transform(once).collect()


def test_fill_model_roundtrip(spark, tmpdir_path):
    m = FillModel({"a": 1.5, "s": "x", "n": None})
    m.save(spark, f"{tmpdir_path}/fill")
    assert FillModel.load(spark, f"{tmpdir_path}/fill").values == m.values


def test_mode_imputer_ties_smallest(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0), ("b", 1.0), ("a", 2.0), (None, None)], "s string, x double")
    m = ModeImputer(["s", "x"]).fit(df)
    assert m.values == {"s": "a", "x": 1.0}
    assert m.transform(df).collect()[-1] == ("a", 1.0)


def test_iqr_fence_is_kept(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 8.5, 100.0]
    # q1=2.5 q3=6.75 iqr=4.25 → upper fence 13.125 ; 100 is replaced by the median 4
    df = spark.createDataFrame([(v,) for v in vals] + [(13.125,)], "x double")
    model = IQROutlierClipper(["x"]).fit(df)
    lo, hi, med = model.bounds["x"]
    out = [r["x"] for r in model.transform(df).collect()]
    assert 13.125 in out or hi < 13.125
    assert model.count_outliers(df).first()["x"] == sum(1 for v in vals + [13.125] if v < lo or v > hi)
    assert out[6] == med


def test_one_hot_names_and_nulls(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, "a", None), (3, None, 1.0)], "id int, c string, p double")
    model = OneHotEncoder(["c", "p"]).fit(df)
    assert model.output_columns() == ["c_a", "c_b", "p_1.0", "p_2.0"]
    rows = model.transform(df).orderBy("id").collect()
    assert rows[0].asDict() == {"id": 1, "c_a": 0, "c_b": 1, "p_1.0": 0, "p_2.0": 1}
    assert rows[2]["c_a"] == 0 and rows[2]["c_b"] == 0
    assert OneHotEncoder(["c"], levels={"c": ["b", "z"]}).fit(df).output_columns() == ["c_b", "c_z"]
    long = sorted(map(tuple, indicators(df, "id", ["c", "p"]).collect()))
    assert long == [(1, "c_b"), (1, "p_2.0"), (2, "c_a"), (3, "p_1.0")]
    b = bool_to_int(spark.createDataFrame([(True,), (False,)], "f boolean")).collect()
    assert [r[0] for r in b] == [1, 0]


def test_scalers(spark):
    vals = [1.0, 2.0, 4.0, 10.0]
    df = spark.createDataFrame([(v, 5.0) for v in vals], "x double, k double")
    std = StandardScaler(["x", "k"]).fit(df)
    assert math.isclose(std.scale["x"], np.std(vals)) and std.scale["k"] == 1.0   # population std; constant → 1
    rob = RobustScaler(["x", "k"]).fit(df)
    assert rob.center["x"] == 3.0 and math.isclose(rob.scale["x"], np.percentile(vals, 75) - np.percentile(vals, 25))
    assert rob.scale["k"] == 1.0
    out = [r["x"] for r in rob.transform(df).collect()]
    assert math.isclose(out[0], (1.0 - 3.0) / rob.scale["x"])


def test_quantile_normal(spark):
    rng = np.random.default_rng(5)
    vals = rng.exponential(size=400)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    model = QuantileNormalizer(["x"], n_quantiles=100).fit(df)
    out = np.array([r["x"] for r in model.transform(df).collect()])
    order = np.argsort(vals)
    assert np.all(np.diff(out[order]) >= -1e-12)                 # monotone
    assert abs(np.median(out)) < 0.05 and out.max() <= 5.3 and out.min() >= -5.3
    assert math.isclose(norm_ppf(np.array([0.975]))[0], 1.959963985, rel_tol=1e-8)


def test_split_stable_disjoint_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "pid")
    a = {r["pid"]: r["s"] for r in df.select("pid", split_flag("pid", 42, 25).alias("s")).collect()}
    b = {r["pid"]: r["s"] for r in df.repartition(7).select("pid", split_flag("pid", 42, 25).alias("s")).collect()}
    assert a == b
    tr, te = train_test_split(df, "pid", 42, 25)
    ids_tr = {r[0] for r in tr.collect()}
    ids_te = {r[0] for r in te.collect()}
    assert not ids_tr & ids_te and len(ids_tr | ids_te) == 2000
    assert 400 < len(ids_te) < 600
    folds = {r[0] for r in kfold(df, "pid", 5).select("fold").distinct().collect()}
    assert folds == {0, 1, 2, 3, 4}


def test_exact_split_sizes(spark):
    from wideframe.operators.split import exact_cut, exact_split_flag
    df = spark.range(1003).withColumnRenamed("id", "k")
    for share in (0.2, 0.25, 1.0, 0.0):
        flag = exact_split_flag(df, "k", 7, share)
        assert df.filter(flag == "test").count() == math.ceil(1003 * share)
    one = {r[0] for r in df.filter(exact_split_flag(df, "k", 7, 0.2) == "test").collect()}
    assert one < {r[0] for r in df.repartition(7).filter(exact_split_flag(df, "k", 7, 0.25) == "test").collect()}
    odd = spark.createDataFrame([("a",)] * 3 + [(None,)], "k string")
    assert odd.filter(exact_split_flag(odd, "k", 1, 0.5) == "test").count() in (3, 4, 1)
    assert odd.limit(0).filter(exact_split_flag(odd.limit(0), "k", 1, 0.5) == "test").count() == 0 and exact_cut(odd, "k", 1, 9) is None


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(60, 2))
    y = 3 + X @ np.array([1.0, -2.0]) + rng.normal(0, 0.3, 60)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(X, y)], "a double, b double, y double")
    for alpha in (0.0, 5.0):
        m = M.fit_linear(df, ["a", "b"], "y", alpha=alpha)
        A = np.column_stack([np.ones(60), X])
        D = np.eye(3)
        D[0, 0] = 0
        beta = np.linalg.solve(A.T @ A + alpha * D, A.T @ y)
        assert np.allclose([m.intercept, *m.coefficients.toArray()], beta, atol=1e-6)


@pytest.fixture(scope="module")
def tree_data(spark):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(300, 3))
    y = 2 * X[:, 0] + np.where(X[:, 1] > 0, 3.0, -1.0) + rng.normal(0, 0.1, 300)
    rows = [(i, float(a), float(b), float(c), float(t)) for i, ((a, b, c), t) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


@pytest.mark.parametrize("kind,params", [("gbt", {"maxIter": 8, "maxDepth": 3}),
                                          ("random_forest", {"numTrees": 5, "maxDepth": 4})])
def test_tree_shap_local_accuracy(spark, tree_data, kind, params):
    feats = ["a", "b", "c"]
    model = M.fit_pipeline(tree_data, feats, "y", kind, 42, **params)
    trees = EX.trees_from_model(model.stages[-1], spark)
    base = EX.expected_value(trees)
    contrib = EX.tree_contributions(tree_data, trees, feats, "id", "y")
    sums = {r["id"]: r["s"] for r in contrib.groupBy("id").agg(F.sum("value").alias("s")).collect()}
    preds = {r["id"]: r["prediction"] for r in model.transform(tree_data).select("id", "prediction").collect()}
    for i, p in preds.items():
        assert math.isclose(sums[i] + base, p, rel_tol=1e-9, abs_tol=1e-9)


def test_tree_shap_matches_brute_force_shapley():
    # one hand-built tree: split on f0 at 0, right child splits on f1 at 0
    t = EX.Tree(left=np.array([1, -1, 3, -1, -1]), right=np.array([2, -1, 4, -1, -1]),
                feature=np.array([0, -1, 1, -1, -1]), threshold=np.array([0.0, 0, 0.0, 0, 0]),
                value=np.array([0, 1.0, 0, 5.0, 9.0]), cover=np.array([10, 4, 6, 2, 4.0]))
    x = np.array([[0.5, -0.5, 0.0]])

    def v(S):  # path-dependent conditional expectation
        def rec(n):
            if t.left[n] < 0:
                return t.value[n]
            f = t.feature[n]
            if f in S:
                return rec(t.left[n] if x[0, f] <= t.threshold[n] else t.right[n])
            return (t.cover[t.left[n]] * rec(t.left[n]) + t.cover[t.right[n]] * rec(t.right[n])) / t.cover[n]
        return rec(0)

    from itertools import combinations
    m = 3
    want = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for k in range(m):
            for S in combinations(others, k):
                w = math.factorial(k) * math.factorial(m - k - 1) / math.factorial(m)
                want[i] += w * (v(set(S) | {i}) - v(set(S)))
    got = EX.tree_shap(x, [t])[0]
    assert np.allclose(got, want)


def test_assign_and_names(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (2.0, 2.0, 5.0), (1.0, 1.0, 3.0)], "x double, y double, s double")
    out = CL.assign_nearest(df, ["x", "y"], {0: (0.0, 0.0), 1: (2.0, 2.0)}).collect()
    assert [r["cluster"] for r in out] == [0, 1, 0]               # the tie goes to the smaller id
    names = {r["cluster"]: r["name"] for r in CL.name_clusters(
        spark.createDataFrame([(0, 1.0), (1, 1.0)], "cluster int, s double"), "cluster", "s").collect()}
    assert names[1] == CL.NAME_HIGH and names[0] == CL.NAME_MODERATE  # tie → label 1 is A


def test_kmeans_pca_silhouette(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(0, 0.3, size=(50, 2))
    b = rng.normal(4, 0.3, size=(50, 2))
    df = spark.createDataFrame([(float(x), float(y)) for x, y in np.vstack([a, b])], "x double, y double")
    z = StandardScaler(["x", "y"]).fit(df).transform(df)
    va, km = CL.fit_kmeans(z, ["x", "y"], k=2)
    assigned = CL.kmeans_assign(z, va, km)
    assert CL.silhouette(assigned, ["x", "y"]) > 0.8
    loadings, explained = CL.fit_pca(z, ["x", "y"], k=2)
    assert explained[0] > 0.9 and max(loadings[0], key=abs) > 0


def test_top_contributions_and_importances(spark):
    df = spark.createDataFrame([(1, 0.1, -3.0, 2.0, 0.5, None)], "player_id int, f0 double, f1 double, f2 double, f3 double, f4 double")
    values = {"T1": {f"f{i}": f"f{i}" for i in range(5)}, "T2": {"f0": "f0 * 2", "f4": "f4"}}
    top = SEL.top_contributions(df, values, 2).orderBy("target", "rank").collect()
    assert [(r["target"], r["feature"], r["rank"]) for r in top] == [("T1", "f1", 1), ("T1", "f2", 2), ("T2", "f0", 1)]
    imp = spark.createDataFrame([("T", "a", 1.0), ("T", "a", 3.0), ("T", "b", 2.5)], "target string, feature string, importance double")
    got = SEL.top_importances(imp, 1).collect()
    assert got[0]["feature"] == "b" and got[0]["importance"] == 2.5


def test_tree_top_k_in_task_matches_window(spark, tree_data):
    feats = ["a", "b", "c"]
    model = M.fit_pipeline(tree_data, feats, "y", "gbt", 42, maxIter=5, maxDepth=3)
    trees = EX.trees_from_model(model.stages[-1], spark)
    full = EX.tree_contributions(tree_data, trees, feats, "id", "y")
    via_window = {tuple(r) for r in full.withColumn("rank", F.row_number().over(
        Window.partitionBy("id").orderBy(F.desc(F.abs("value")), "feature"))).filter("rank <= 2").select("id", "feature", "rank").collect()}
    in_task = {tuple(r) for r in EX.tree_contributions(tree_data, trees, feats, "id", "y", top_k=2)
               .select("id", "feature", "rank").collect()}
    assert in_task == via_window


def test_kfold_metrics_pool_out_of_fold(spark, tree_data):
    r = M.kfold_metrics(tree_data, ["a", "b", "c"], "y", "id", "linear", k=4)
    assert r["n"] == 300 and r["k"] == 4
    # a linear fit explains most of this target; out-of-fold R² is below 1 and well above 0
    assert 0.5 < r["r2_kfold"] < 1.0


def test_seed_ensemble_mean_between_members(spark, tree_data):
    feats = ["a", "b", "c"]
    ens, seen, unseen = M.fit_seed_ensemble(tree_data, feats, "y", "id", kind="gbt", maxIter=5, maxDepth=2)
    parts = []
    for i, m in enumerate(ens.members):
        parts.append(m.transform(tree_data).select("id", F.col("prediction").alias(f"p{i}")))
    joined = parts[0].join(parts[1], "id").join(parts[2], "id").join(
        ens.transform(tree_data).select("id", "prediction"), "id")
    for r in joined.collect():
        ps = [r["p0"], r["p1"], r["p2"]]
        assert min(ps) - 1e-9 <= r["prediction"] <= max(ps) + 1e-9
        assert math.isclose(r["prediction"], sum(ps) / 3, rel_tol=1e-12)
    # rows unseen by every member: disjoint from each member's training side
    ids = {x[0] for x in unseen.select("id").collect()}
    common = {x[0] for x in seen.select("id").collect()}
    assert ids and common
    for s in M.ENSEMBLE_SEEDS:
        tr, _ = train_test_split(tree_data, "id", s, 25)
        train = {x[0] for x in tr.select("id").collect()}
        assert not ids & train and common <= train


def test_robust_scaled_median_is_zero(spark):
    rng = np.random.default_rng(9)
    vals = rng.lognormal(size=201)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    out = RobustScaler(["x"]).fit(df).transform(df)
    assert abs(np.median([r[0] for r in out.collect()])) < 1e-12


def test_variance_corr_ranking_equals_two_steps(spark):
    from wideframe.operators import select as SEL
    rng = np.random.default_rng(7)
    n = 400
    y = rng.normal(size=n)
    rows = []
    for i in range(n):
        rows.append((float(y[i]), float(y[i] * 2 + rng.normal()), 1.0,            # strong, constant
                     None if i % 5 == 0 else float(-y[i] + rng.normal()),          # nulls (pairwise)
                     float(rng.normal() * 0.01),                                    # variance < 0.01
                     float(rng.normal())))
    df = spark.createDataFrame(rows, "y double, a double, c double, b double, tiny double, noise double")
    feats = ["a", "c", "b", "tiny", "noise"]
    pool = SEL.variance_filter(df, feats, 0.01)
    two = [(r["feature"], r["rank"]) for r in SEL.corr_ranking(df, pool, "y").orderBy("rank").collect()]
    one = [(r["feature"], r["rank"]) for r in SEL.variance_corr_ranking(df, feats, "y", 0.01).orderBy("rank").collect()]
    assert one == two
    assert [f for f, _ in one] == ["a", "b", "noise"]   # constant and low-variance columns dropped


def test_skip_rates_reference_scalar_on_every_row(spark):
    from wideframe.plans.prepare import skip_rate_summary, skip_rates
    rows = [(1, -1.0, 2.0, -1.0), (2, -1.0, -1.0, 3.0), (3, 4.0, None, 5.0)]
    df = spark.createDataFrame(rows, "id long, P01 double, P02 double, T01 double")
    out = skip_rates(df).orderBy("id").collect()
    # P: three −1 cells / 2 columns; T: one / 1 column; all: four / 3 columns
    assert {(r["taxa_pulos_P"], r["taxa_pulos_T"], r["taxa_pulos_geral"]) for r in out} == {(1.5, 1.0, 4 / 3)}
    assert [r["id"] for r in out] == [1, 2, 3]
    assert tuple(skip_rate_summary(df).first()) == (1.5, 1.0, 4 / 3)
    row = skip_rates(df, mode="row").orderBy("id").first()
    assert (row["taxa_pulos_P"], row["taxa_pulos_T"]) == (0.5, 1.0)


def test_affine_apply_odd_names_and_int_params(spark):
    from wideframe.operators.scale import AffineModel
    df = spark.createDataFrame([(1, 3.0), (2, None)], "`a-b c` int, x double")
    out = AffineModel({"a-b c": 1, "x": 1.5}, {"a-b c": 2, "x": 0.5}).transform(df).collect()
    assert [tuple(r) for r in out] == [(0.0, 3.0), (0.5, None)]


def test_silhouette_refuses_null_features(spark):
    df = spark.createDataFrame([(0, 1.0), (0, None), (1, 5.0)], "cluster int, x double")
    with pytest.raises(Exception):
        CL.silhouette(df, ["x"])


def test_saved_state_round_trip(spark, tmpdir_path):
    from wideframe.operators.cluster import ClusterModel
    from wideframe.operators.encode import OneHotModel
    from wideframe.operators.impute import FillModel, OutlierModel
    from wideframe.operators.scale import AffineModel, QuantileNormalModel
    from wideframe.plans.state import load_state, save_state
    affine = AffineModel({"x": 0.1}, {"x": 1 / 3})
    for i, obj in enumerate((FillModel({"a": 0.1, "b": None, "c": "z"}), affine, OutlierModel({"x": (0.1, 2.0, 1.0), "y": (None, None, None)}),
                             OneHotModel({"c": ["a", "b"], "n": [1, 2]}), QuantileNormalModel({"x": [0.0, 1 / 7]}, [0.0, 1.0], "uniform"),
                             ClusterModel(["x"], affine, {0: (0.5,), 1: (-0.5,)}, ((1.0,),), {0: "A"}))):
        save_state(spark, obj, f"{tmpdir_path}/{i}")
        assert load_state(spark, f"{tmpdir_path}/{i}") == obj


def test_saved_ensemble_scores_alike(spark, tree_data, tmpdir_path):
    from wideframe.plans.state import load_state, save_state
    ens, _, _ = M.fit_seed_ensemble(tree_data, ["a", "b", "c"], "y", "id", kind="gbt", maxIter=2, maxDepth=2)
    save_state(spark, ens, tmpdir_path + "/ens")
    again = load_state(spark, tmpdir_path + "/ens")
    pick = lambda e: sorted(map(tuple, e.transform(tree_data).select("id", "prediction").collect()))
    assert pick(ens) == pick(again)


def test_predictions_are_named_after_their_target(spark, tmpdir_path):
    from wideframe.plans.player import player_table
    from wideframe.plans.scoring import TargetModel, fit_scoring_plan, score
    from wideframe.plans.state import load_state, save_state
    raw = player_table(spark, "/root/testdata/sf0.001")
    plan = fit_scoring_plan(raw, linear={"Target3": (3.0, {})}, targets=(
        TargetModel("Target2", 2, ["P_mean", "sono_total_X_P_mean", "absent"], ["sono_total_X_P_mean"]),
        TargetModel("Target1", 1, ["P_mean", "T_mean"])))
    rows = score(raw, plan, "player_id").collect()
    save_state(spark, plan, tmpdir_path + "/plan")
    assert score(raw, load_state(spark, tmpdir_path + "/plan"), "player_id").collect() == rows
    assert {r["Previsão T3"] for r in rows} == {3.0}
    t1 = np.array([r["Previsão T1"] for r in rows])
    truth = np.array([r["Target1"] if r["Target1"] is not None else np.nan for r in raw.select("Target1").collect()])
    assert abs(t1.mean() - np.nanmean(truth)) < 0.5 * np.nanstd(truth)
    assert len({r["Previsão T2"] for r in rows}) > 10
    none = score(raw, fit_scoring_plan(raw), "player_id").first()
    assert (none["Previsão T1"], none["Previsão T2"], none["Previsão T3"]) == (None, None, None)


def test_search_draws_stay_in_their_space():
    from wideframe.operators import tuning as TU
    for target, space in TU.SEARCH_SPACES.items():
        drawn = TU.draw_settings(space, 50, seed=1)
        assert drawn == TU.draw_settings(space, 50, seed=1) and len(drawn) == 50
        for d in drawn:
            assert all(space[k][0] <= d[k] <= space[k][1] for k in TU.SETTINGS)


def test_wide_tables_are_profiled_in_passes(spark):
    from wideframe.operators import profile as PR
    n = 1000
    df = spark.range(4).select("id", *[F.when(F.col("id") > i % 4, F.lit(float(i))).alias(f"c{i}") for i in range(n)])
    got = {r["Coluna"]: r["Missing"] for r in PR.missing_profile(df, [f"c{i}" for i in range(n)]).collect()}
    assert got == {f"c{i}": i % 4 + 1 for i in range(n)}


def test_registered_fits_run_the_default_sizes(spark, monkeypatch):
    from wideframe.plans import catalog_models as CM

    class Seen(Exception):
        pass

    def see(*args, **params):
        raise Seen(params)

    sizes = {"numTrees", "maxDepth", "maxIter"}

    class Frame:
        def unpersist(self):
            pass

    monkeypatch.setattr(CM, "engineered", lambda spark, sf_dir: Frame())
    monkeypatch.setattr(CM, "scratch_path", lambda *a: "")
    monkeypatch.setattr(CM.HB, "bin_table", lambda *a, **p: None)
    fits = []
    monkeypatch.setattr(CM.HB, "Booster", lambda table, given: fits.extend(given) or see())
    for fit in (CM.q_seed_ensemble, CM.q_forest_oob):
        with pytest.raises(Seen):
            fit(None, "")
    assert [(f.rounds, f.depth) for f in fits] == [(100, 5)] * 6 + [(1, 6)] * 300
    monkeypatch.setattr(CM.TU, "halving_search", lambda table, trials, **p: see(trials=trials))
    monkeypatch.setattr(CM.HB, "bin_table", lambda *a, **p: Frame())
    with pytest.raises(Seen) as e:
        CM.q_search(None, "")
    trials = e.value.args[0]["trials"]
    assert len(trials) == 350 and sum(len(t.fits) for t in trials) == 1550 and max(f.rounds for t in trials for f in t.fits) > 700
    for name in ("leaderboard", "fit_seed_ensemble", "kfold_metrics", "fit_pipeline"):
        monkeypatch.setattr(CM.M, name, see)
    for fit in (CM.q_kfold_metrics, CM.q_importances, CM.q_tree_contrib):
        with pytest.raises(Seen) as e:
            fit(None, "")
        assert not sizes & set(e.value.args[0])
    monkeypatch.setattr(CM.M, "fit_pipeline", lambda *a, **p: None)
    monkeypatch.setattr(CM.M, "importances", lambda *a, **p: [])
    with pytest.raises(Seen) as e:
        CM.q_importances(None, "")  # its ensemble
    assert not sizes & set(e.value.args[0])
    with pytest.raises(Seen) as e:
        CM.q_leaderboard(None, "")
    assert (e.value.args[0]["maxIter"], e.value.args[0]["boosterIter"], e.value.args[0]["numTrees"]) == (100, 100, 100)
