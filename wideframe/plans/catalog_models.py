"""Fit-type queries (rows-only checks): model zoo and leaderboard, search,
seed ensembles, importances, tree contributions, clustering fits, the quantile
transform and file-arrival scoring. Their numerical properties are tested
against NumPy in ``tests/``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as FE
from ..operators import cluster as CL
from ..operators import explain as EX
from ..operators import histboost as HB
from ..operators import models as M
from ..operators import restarts as RS
from ..operators import select as SEL
from ..operators import tuning as TU
from ..operators.metrics import overfitting_value
from ..operators.quantile import quantile_values
from ..operators.scale import QuantileNormalizer, StandardScaler
from ..operators.split import hash_bucket
from ..session import scratch_path
from .catalog import FIXED_ENSEMBLE_SCALE, FIXED_LINEAR, engineered, register, round6
from .player import ID_COL, TARGETS, player_table
from .prepare import materialize

MODEL_FEATURES = ["P_mean", "P_std", "T_mean", "T_std", "F_mean_geral", "F_final_mean", "F_sono_mean",
                  "sono_total", "Acordar", "F0103"]


#: Sizes of the registered leaderboard, the zoo's own: a forest of 100 trees of
#: depth 10 and 100 boosting rounds.
LEADERBOARD_SIZES = {"numTrees": 100, "maxDepth": 10, "maxIter": 100, "boosterIter": 100}


@register("model_leaderboard", "M1 M2 M3 M4 M5 M6 M9 X1")
def q_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model on every target (80/20 hash split), R²/RMSE/MAE on the
    test side, with the best model per target flagged."""
    df = engineered(spark, sf_dir)
    sizes = {k: v for k, v in LEADERBOARD_SIZES.items() if k != "maxDepth"}
    board = M.leaderboard(df, MODEL_FEATURES, list(TARGETS), ID_COL,
                          kinds=("linear", "ridge", "random_forest", "gbt", "booster", "booster_symmetric"), test_pct=20, **sizes)
    df.unpersist()
    best = M.best_models(board)
    out = board.join(F.broadcast(best), "target").withColumn("is_best", F.col("model") == F.col("best_model"))
    return round6(out.drop("best_model", "best_r2").withColumn("sizes", F.lit(str(sorted(LEADERBOARD_SIZES.items())))))


@register("linear_leaderboard", "M1 M2 M6 M9 X1 Z1")
def q_linear_leaderboard(spark, sf_dir):
    """The closed-form part of the zoo on two features, which SQL can repeat."""
    df = engineered(spark, sf_dir)
    board = M.leaderboard(df, ["P_mean", "T_mean"], list(TARGETS), ID_COL, kinds=("linear", "ridge"), test_pct=20)
    return round6(board)


#: Rounds without a lower held-out error after which a search's model stops.
SEARCH_PATIENCE = 20

#: Borders of the binned table that search, ensembles and boosters share.
BORDERS = 128


@register("gbt_random_search", "M5 M7 X2")
def q_search(spark, sf_dir, trials: int | None = None):
    """Successive halving over each target's own space, folds, trials and
    rounds; all trials and folds of all targets share each pass."""
    df = engineered(spark, sf_dir)
    folds = {f"fold{k}": (hash_bucket(ID_COL, 42, 1 << 30) % k).cast("int") for k in sorted({s["folds"] for s in TU.SEARCH_SPACES.values()})}
    table = HB.bin_table(df, MODEL_FEATURES, list(TARGETS), ID_COL, folds, borders=BORDERS)
    df.unpersist()
    drawn = [x for t in TARGETS for x in TU.trials_for(t, TU.SEARCH_SPACES[t], trials, patience=SEARCH_PATIENCE)]
    tried = TU.halving_search(table, drawn, store=scratch_path(spark, f"search-{uuid.uuid4().hex}"))
    table.release()
    rows = [(t.label, t.number, t.score, json.dumps({k: getattr(t.fits[0], k) for k in TU.SETTINGS}, sort_keys=True), t.best, len(t.fits),
             t.rung, t.rounds) for t in tried]
    return round6(spark.createDataFrame(rows, "target string, trial int, mean_cv_r2 double, settings string, best boolean, "
                                              "folds int, last_rung int, rounds int"))


@register("seed_ensemble_metrics", "M5 M8 M9 M10")
def q_seed_ensemble(spark, sf_dir):
    """Three boosted-tree members on seeds 42/123/456, mean prediction, metrics
    on the rows no member trained on, and the overfitting ratio; the members of
    both targets grow together."""
    df = engineered(spark, sf_dir)
    labels = ("Target2", "Target3")
    table = HB.bin_table(df, MODEL_FEATURES, labels, ID_COL, TU.split_parts(ID_COL, TU.ENSEMBLE_SEEDS, 25), borders=BORDERS)
    df.unpersist()
    fits = [f for t in labels for f in TU.seed_fits(M.boosted_fits(t, None, 42)["gbt"])]
    booster = HB.Booster(table, fits)
    booster.grow()
    n = len(TU.ENSEMBLE_SEEDS)
    members = [list(range(i * n, (i + 1) * n)) for i in range(len(labels))]
    got = booster.evaluate([(m, rule) for m in members for rule in ("train", "held")])
    booster.release()
    table.release()
    rows = [(t, float(tr["r2"]), float(te["r2"]), float(te["mae"]), float(te["rmse"]), overfitting_value(float(tr["r2"]), float(te["r2"])),
             len(MODEL_FEATURES), n, te["n"]) for t, tr, te in zip(labels, got[::2], got[1::2])]
    out = spark.createDataFrame(rows, "target string, r2_train double, r2_test double, mae_test double, "
                                      "rmse_test double, overfitting_pct double, n_features int, "
                                      "ensemble_size int, n_test long")
    return round6(out)


@register("forest_oob_metrics", "M3 M12 M9")
def q_forest_oob(spark, sf_dir):
    """Out-of-bag R²/MAE/RMSE of a bagged forest per target: every row is scored
    by the trees whose bag does not hold it, in one pass."""
    df = engineered(spark, sf_dir)
    table = HB.bin_table(df, MODEL_FEATURES, list(TARGETS), ID_COL, borders=32)
    df.unpersist()
    trees = {t: TU.forest_fits(t) for t in TARGETS}
    forest = HB.Booster(table, [f for fits in trees.values() for f in fits])
    forest.grow()
    at, asked = 0, []
    for fits in trees.values():
        asked.append((list(range(at, at + len(fits))), "bag"))
        at += len(fits)
    rows = [(t, r["r2"], r["mae"], r["rmse"], r["n"], len(fits))
            for (t, fits), r in zip(trees.items(), forest.evaluate(asked))]
    table.release()
    return round6(spark.createDataFrame([tuple(None if v is None else float(v) if isinstance(v, float) else v for v in r) for r in rows],
                                        "target string, r2_oob double, mae_oob double, rmse_oob double, n long, trees int"))


@register("booster_one_tree", "M5")
def q_one_tree(spark, sf_dir):
    """One symmetric tree of depth 2 on three features with up to 8 borders:
    its splits, leaf values and rows, which SQL can repeat. Features are cut to
    4 decimals and borders lie between those values."""
    cols = ["P_mean", "T_mean", "sono_total"]
    four = [F.expr(f"round({c} * 1e4) / 1e4").alias(c) for c in cols]
    df = materialize(engineered(spark, sf_dir, keep=False).select(ID_COL, "Target1", *four))
    values = quantile_values(df, cols, [i / 9 for i in range(1, 9)])
    cuts = [sorted({float(round(v * 1e4)) / 1e4 + 0.00005 for v in values[c]}) for c in cols]
    table = HB.bin_table(df, cols, ["Target1"], ID_COL, cuts=cuts)
    fitted = HB.Booster(table, [HB.Fit("Target1", rounds=1, depth=2, rate=0.1, penalty=3.0)]).grow()[0]
    levels, leaves = fitted.trees[0]
    (f1, c1), (f2, c2) = ((level[0][0], cuts[level[0][0]][level[1][0]]) for level in levels)
    side = lambda f, c: F.expr(f"CASE WHEN {cols[f]} > {c!r}D THEN 1 ELSE 0 END")
    rows = df.filter("Target1 IS NOT NULL").groupBy((2 * side(f1, c1) + side(f2, c2)).alias("leaf")).agg(F.count("*").alias("rows"))
    told = spark.createDataFrame([(i, cols[f1], c1, cols[f2], c2, float(v)) for i, v in enumerate(leaves)],
                                 "leaf int, feature1 string, border1 double, feature2 string, border2 double, value double")
    table.release()
    return round6(told.join(rows, "leaf"))


@register("kfold_tree_metrics", "M12 X2 M9")
def q_kfold_metrics(spark, sf_dir):
    """Out-of-fold R²/MAE/RMSE (k = 3, hash folds) of a forest per target — the
    tree counterpart of the closed-form linear LOO."""
    df = engineered(spark, sf_dir)
    rows = []
    for t in TARGETS:
        r = M.kfold_metrics(df, MODEL_FEATURES, t, ID_COL, "random_forest", k=3)
        rows.append((t, r["r2_kfold"], r["mae_kfold"], r["rmse_kfold"], r["n"], r["k"]))
    return round6(spark.createDataFrame(rows, "target string, r2_kfold double, mae_kfold double, "
                                              "rmse_kfold double, n long, k int"))


@register("tree_importances", "M14 K7 U2")
def q_importances(spark, sf_dir):
    """Importances per target: one forest for Target1, mean over a seed
    ensemble for Target2, |coef|·std for a linear model on Target3; top 20."""
    df = engineered(spark, sf_dir)
    rows = []
    rf = M.fit_pipeline(df, MODEL_FEATURES, "Target1", "random_forest", 42)
    rows += [("Target1", f, v) for f, v in M.importances(rf, MODEL_FEATURES)]
    ens, _, _ = M.fit_seed_ensemble(df, MODEL_FEATURES, "Target2", ID_COL, kind="gbt")
    for m in ens.members:
        rows += [("Target2", f, v) for f, v in M.importances(m, MODEL_FEATURES)]
    lin = M.fit_pipeline(df, MODEL_FEATURES, "Target3", "linear")
    rows += [("Target3", f, v) for f, v in M.importances(lin, MODEL_FEATURES, df)]
    imp = spark.createDataFrame(rows, "target string, feature string, importance double")
    return round6(SEL.top_importances(imp, 20))


@register("tree_contributions", "M15 K8")
def q_tree_contrib(spark, sf_dir):
    """Path-dependent TreeSHAP of a boosted-tree model for every player (long
    form), then the 15 largest per player."""
    df = engineered(spark, sf_dir)
    model = M.fit_pipeline(df, MODEL_FEATURES, "Target1", "gbt", 42)
    trees = EX.trees_from_model(model.stages[-1], spark)
    return round6(EX.tree_contributions(df, trees, MODEL_FEATURES, ID_COL, "T1", top_k=15))


def _cluster_frame(spark, sf_dir):
    df = engineered(spark, sf_dir).withColumn("raw_p_mean", F.col("P_mean"))
    cols = list(FE.CLUSTER_FEATURES)
    z = materialize(StandardScaler(cols).fit(df).transform(df))
    return z, cols


def _best_start(z, cols):
    """The best of ten k-means starts as {label: centre}, and all starts."""
    starts = RS.fit_restarts(z, cols, k=2, starts=10, seed=42)
    return {i: tuple(map(float, c)) for i, c in enumerate(starts[0].centres)}, starts


@register("kmeans_profiles", "C1 C4 C5 A16 A17")
def q_kmeans(spark, sf_dir):
    z, cols = _cluster_frame(spark, sf_dir)
    centres, _ = _best_start(z, cols)
    assigned = CL.assign_nearest(z, cols, centres, "cluster")
    sil = CL.silhouette(assigned, cols, "cluster")
    names = CL.name_clusters(assigned, "cluster", "raw_p_mean").select("cluster", "name")
    agg = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"), F.avg("raw_p_mean").alias("P_mean"))
    return round6(agg.join(F.broadcast(names), "cluster").withColumn("silhouette", F.lit(float(sil))))


@register("kmeans_check", "C1 C2")
def q_kmeans_check(spark, sf_dir):
    """What k-means with ten starts must satisfy, worked out anew over the whole
    table by column expressions: the largest distance between a kept centre and
    the mean of its rows (Lloyd's fixed point), and the inertia of every start's
    centres, of which none is below the kept one's."""
    z, cols = _cluster_frame(spark, sf_dir)
    centres, starts = _best_start(z, cols)
    both = CL.assign_nearest(z, cols, centres, "nearest")
    apart = lambda c: " + ".join(f"power({x} - ({float(v)!r}D), 2)" for x, v in zip(cols, c))
    least = [F.expr(f"sum(least({', '.join(apart(c) for c in s.centres)}))").alias(f"i{n}") for n, s in enumerate(starts)]
    one = both.agg(F.count(F.lit(1)).alias("rows"), *least,
                   *[F.avg(F.when(F.col("nearest") == k, F.col(c))).alias(f"m{k}_{j}") for k in centres for j, c in enumerate(cols)])
    off = F.greatest(*[F.abs(F.col(f"m{k}_{j}") - F.lit(centres[k][j])) for k in centres for j in range(len(cols))])
    told = F.greatest(*[F.abs(F.col(f"i{n}") - F.lit(float(s.inertia))) / F.lit(max(1.0, float(s.inertia))) for n, s in enumerate(starts)])
    lowest = F.least(*[F.col(f"i{n}") for n in range(len(starts))])
    return one.select("rows", F.lit(len(starts)).alias("starts"), (off < 0.05).alias("centres_are_means"),
                      (F.col("i0") <= lowest * (1 + 1e-9)).alias("none_is_lower"), (told < 1e-6).alias("inertia_is_right"))


@register("pca_check", "C3")
def q_pca_check(spark, sf_dir):
    """Two fitted components recomputed over the table: unit length, right
    angle, uncorrelated coordinates, explained share = variance share."""
    z, cols = _cluster_frame(spark, sf_dir)
    loadings, explained = CL.fit_pca(z, cols, k=2)
    p = CL.project(z.select(*cols), cols, loadings, "pc")
    total = " + ".join(f"var_samp({c})" for c in cols)
    one = p.agg(F.expr(f"var_samp(pc1) / ({total})").alias("s1"), F.expr(f"var_samp(pc2) / ({total})").alias("s2"),
                F.expr("covar_samp(pc1, pc2)").alias("cov")).first()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    row = (dot(loadings[0], loadings[0]), dot(loadings[1], loadings[1]), abs(dot(*loadings)), abs(one["cov"]),
           abs(one["s1"] - explained[0]), abs(one["s2"] - explained[1]))
    return round6(spark.createDataFrame([row], "length1 double, length2 double, angle double, covariance double, gap1 double, gap2 double"))


@register("tree_contributions_check", "M15")
def q_tree_contrib_check(spark, sf_dir):
    """Local accuracy for every player: base + sum of contributions = prediction."""
    df = engineered(spark, sf_dir)
    model = M.fit_pipeline(df, MODEL_FEATURES, "Target1", "gbt", 42, maxIter=5, maxDepth=3)
    trees = EX.trees_from_model(model.stages[-1], spark)
    base = EX.expected_value(trees)
    sums = EX.tree_contributions(df, trees, MODEL_FEATURES, ID_COL, "T1").groupBy(ID_COL).agg(F.sum("value").alias("s"))
    pred = model.transform(df).select(ID_COL, "prediction")
    return round6(pred.join(sums, ID_COL).agg(F.count(F.lit(1)).alias("players"), F.max(
        F.round(F.abs(F.col("prediction") - F.col("s") - F.lit(base)), 6)).alias("largest_gap")))


@register("quantile_normal_small", "Z3")
def q_quantile_normal_small(spark, sf_dir):
    """Z3 with both stages on 11 quantiles, which SQL can repeat."""
    df = engineered(spark, sf_dir)
    cols = ["P_mean", "T_mean", "F_mean_geral"]
    return round6(QuantileNormalizer(cols, n_quantiles=11).fit(df).transform(df.select(ID_COL, *cols)))


@register("pca_fit", "C3")
def q_pca_fit(spark, sf_dir):
    z, cols = _cluster_frame(spark, sf_dir)
    loadings, explained = CL.fit_pca(z, cols, k=2)
    rows = [(j + 1, c, float(w), float(explained[j])) for j, comp in enumerate(loadings) for c, w in zip(cols, comp)]
    return round6(spark.createDataFrame(rows, "component int, feature string, loading double, explained_ratio double"))


@register("quantile_normal", "Z3")
def q_quantile_normal(spark, sf_dir):
    df = engineered(spark, sf_dir)
    cols = ["P_mean", "T_mean", "F_mean_geral"]
    model = QuantileNormalizer(cols, n_quantiles=1000).fit(df)
    return round6(model.transform(df.select(ID_COL, *cols)))


@register("quantile_uniform", "Z3")
def q_quantile_uniform(spark, sf_dir):
    """Z3, uniform stage (oracle-checked): 11 exact quantiles per column, then
    the model's two-direction interpolation (ties map to the middle)."""
    df = engineered(spark, sf_dir)
    cols = ["P_mean", "T_mean", "F_mean_geral"]
    model = QuantileNormalizer(cols, n_quantiles=11, output="uniform").fit(df)
    return round6(model.transform(df.select(ID_COL, *cols)))


@register("stream_scoring", "W1 S1 S3 S5 M13 L7")
def q_stream(spark, sf_dir):
    """Upload files derived from the player table arrive in a folder; a
    ``readStream`` scores each with frozen training statistics and appends to
    the history, which is read back."""
    from ..sources.sinks import read_history
    from ..streaming.score_stream import run_until_done, start_scoring_stream
    from .scoring import fit_scoring_plan

    raw = player_table(spark, sf_dir).withColumnRenamed(ID_COL, "Código de Acesso")
    plan = fit_scoring_plan(raw, linear=FIXED_LINEAR, ensemble_scale=FIXED_ENSEMBLE_SCALE)
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    inbox, hist, ckpt = f"{base}/inbox", f"{base}/history", f"{base}/checkpoint"
    # three uploads, split by a hash of the id (whole table, no rows dropped):
    # comma and UTF-8; semicolon and decimal comma; latin-1, columns in reverse order
    as_text = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
    part = F.abs(F.xxhash64(F.col("`Código de Acesso`"))) % 3
    as_text.filter(part == 0).write.option("header", True).csv(f"{inbox}/upload_0")
    comma = [F.regexp_replace(F.col(f"`{c}`"), r"^(-?[0-9]+)\.([0-9]+)$", "$1,$2").alias(c) for c in raw.columns]
    as_text.filter(part == 1).select(*comma).write.option("header", True).option("sep", ";").csv(f"{inbox}/upload_1")
    as_text.filter(part == 2).select(*reversed(raw.columns)).withColumn("Observação", F.lit("manhã")).write.option(
        "header", True).option("encoding", "ISO-8859-1").csv(f"{inbox}/upload_2")
    run_until_done(start_scoring_stream(spark, f"{inbox}/*", hist, ckpt, plan, "Código de Acesso", user_id=1))
    # the upload timestamp and batch id depend on arrival; the scored records do not
    return read_history(spark, hist).select("user_id", "jogador_id", "pred_t1", "pred_t2", "pred_t3")


@register("uploads_readback", "S1 P1 P13")
def q_uploads(spark, sf_dir):
    """The player table written as three uploads in the three dialects and read
    back: equal to the player table."""
    from ..functions.families import numeric_columns
    from ..sources.schema import read_csv
    raw = player_table(spark, sf_dir)
    base = scratch_path(spark, f"uploads-{uuid.uuid4().hex}")
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    part = F.abs(F.xxhash64(F.col(ID_COL))) % 3
    text.filter(part == 0).write.option("header", True).csv(f"{base}/a")
    comma = [F.regexp_replace(c, r"^(-?[0-9]+)\.([0-9]+)$", "$1,$2").alias(c) for c in raw.columns]
    text.filter(part == 1).select(*comma).write.option("header", True).option("sep", ";").csv(f"{base}/b")
    text.filter(part == 2).select(*reversed(raw.columns)).withColumn("Nota", F.lit("vermelhão")).write.option(
        "header", True).option("encoding", "ISO-8859-1").csv(f"{base}/c")
    back, _ = read_csv(spark, [f"{base}/a", f"{base}/b", f"{base}/c"])
    number = set(numeric_columns(raw, exclude=(ID_COL,)))
    cols = [F.col(c).cast("double").alias(c) if c in number else F.regexp_replace(c, r"\.", ",").alias(c) if c == "F0103"
            else F.col(c).cast(raw.schema[c].dataType).alias(c) for c in raw.columns]
    if back.filter("Nota IS NOT NULL AND Nota <> 'vermelhão'").limit(1).count():
        raise ValueError("latin-1 text was not decoded")
    return round6(back.select(*cols))


@register("export_readback", "S4 S8 Z1")
def q_export_readback(spark, sf_dir):
    """S4/S8 round trip (oracle-checked): the scaled table and the correlation
    report are written by the export sink to the shared folder; the scaled
    table is read back from parquet and returned."""
    from ..operators import profile as PR
    from ..sources.sinks import export_tables

    eng = engineered(spark, sf_dir)
    feats = ["P_mean", "T_mean", "F_mean_geral", "sono_total"]
    scaled = StandardScaler(feats).fit(eng).transform(eng.select(ID_COL, *feats, *TARGETS))
    tables = {"scaled": scaled, "correlations": PR.corr_report(eng, feats, list(TARGETS))}
    paths = export_tables(tables, scratch_path(spark, f"export-{uuid.uuid4().hex}"))
    return round6(spark.read.parquet(paths[0]))


@register("export_outputs", "S4 S8 S7 A14 A12")
def q_export(spark, sf_dir):
    """Multi-output export (clean table, scaled table, target summary,
    correlation report) to the shared folder, plus the fitted imputation values
    as a parameter table; returns what was written (name, rows) read back."""
    from ..operators import profile as PR
    from ..sources.sinks import export_tables
    from .prepare import clean_for_training

    # one cleaning (and its medians) for the clean table, the values and the features
    clean, fill = clean_for_training(player_table(spark, sf_dir), extra_medians=("QtdHorasDormi",))
    feats = ["P_mean", "T_mean", "F_mean_geral", "sono_total"]
    eng = materialize(FE.target1_features(clean, fill.extra["QtdHorasDormi"]).select(ID_COL, *feats, *TARGETS))
    scaled = StandardScaler(feats).fit(eng).transform(eng)
    tables = {"clean": clean, "scaled": scaled,
              "target_summary": PR.describe(eng, list(TARGETS)),
              "correlations": PR.corr_report(eng, feats, list(TARGETS))}
    base = scratch_path(spark, f"export-{uuid.uuid4().hex}")
    paths = export_tables(tables, base)
    fill.save(spark, f"{base}/imputer")
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(n))
             for n, p in zip(tables, paths)]
    parts.append(spark.read.parquet(f"{base}/imputer").agg(F.count(F.lit(1)).alias("rows"))
                 .withColumn("name", F.lit("imputer_params")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("name", "rows")
