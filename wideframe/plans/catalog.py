"""Registered queries: one per inventory operator group, each ``(spark, sf_dir) → DataFrame``.

Every query reads the driver tables (through the stand-in player table or
directly) over whole tables. Doubles are rounded to 6 decimals in the output so
that the DuckDB oracle and Spark agree despite summation order.

Apply-type model operators (scoring, ensemble, contributions, cluster
assignment, projection) use the fixed parameters in ``FIXED_*`` so the oracle
can check them; fit-type operators live in ``catalog_models``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import families as FAM
from ..functions import features as FE
from ..functions.rowstats import row_mean, with_row_stats
from ..functions.sqltext import lit as sql_lit, plus, q
from ..operators import profile as PR
from ..operators import select as SEL
from ..operators.encode import OneHotEncoder, bool_to_int
from ..operators.impute import IQROutlierClipper, MedianImputer, ModeImputer
from ..operators.metrics import linear_loo, metric_aggs, overfitting_pct
from ..operators.scale import RobustScaler, StandardScaler
from ..operators.split import exact_split_flag, kfold, split_flag
from ..sources.schema import align_to, dedupe_columns
from .player import ID_COL, PLAYER_COLUMNS, TARGETS, player_table
from .prepare import (ID_COLUMNS, clean_for_training, coerce_families, guard_ranges,
                      materialize, null_skips, skip_rates)

QUERIES: dict = {}
# inventory ids covered by each query (for the coverage table in the README)
COVERS: dict = {}


def register(name, covers=""):
    def deco(fn):
        QUERIES[name] = fn
        COVERS[name] = covers
        return fn
    return deco


def round6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (for the oracle comparison).

    ``round(x·1e6)/1e6`` rounds the binary value half away from zero, as
    DuckDB does; ``round(x, 6)`` would round the shortest decimal string
    instead (64.3442025 stored as 64.34420249999… → .203 vs .202).
    """
    fields = df.schema.fields
    if not any(f.dataType.typeName() in ("double", "float") for f in fields):
        return df
    return df.selectExpr(*[f"round({q(f.name)} * 1000000D) / 1000000D AS {q(f.name)}"
                           if f.dataType.typeName() in ("double", "float") else q(f.name) for f in fields])


# Fixed parameters of the apply-type checks (a linear scorer per target over
# engineered features, cluster centroids and PCA loadings in standardized
# space). They stand in for fitted artefacts so that DuckDB can recompute the
# same numbers from the same tables.
FIXED_LINEAR = {
    "Target1": (20.0, {"P_mean": 1.5, "T_mean": 2.0, "F_mean_geral": -0.5, "sono_total": 0.8}),
    "Target2": (100.0, {"P_mean": 0.7, "T_std": -1.2, "F_final_mean": 0.3, "Acordar": 2.5}),
    "Target3": (15.0, {"T_mean": 3.0, "P_std": 0.4, "F_sono_mean": -0.2, "QtdHorasDormi": 1.1}),
}
FIXED_ENSEMBLE_SCALE = (0.9, 1.0, 1.1)
FIXED_CENTROIDS = {0: (-0.5, -0.3, -0.4, 0.1, 0.0), 1: (0.6, 0.4, 0.5, -0.1, 0.0)}
FIXED_LOADINGS = ((0.6, 0.3, 0.6, 0.2, 0.4), (-0.2, 0.7, -0.1, 0.5, -0.45))
PRED_NAMES = {"Target1": "pred_t1", "Target2": "pred_t2", "Target3": "pred_t3"}


# --------------------------------------------------------------------------
# shared stages
# --------------------------------------------------------------------------

def nulled_player(spark, sf_dir) -> DataFrame:
    """Coerced, range-guarded, skip answers → NULL (not imputed)."""
    df = coerce_families(player_table(spark, sf_dir))
    df = guard_ranges(df)
    return null_skips(df, FAM.all_family_columns(df.columns))


def clean_player(spark, sf_dir) -> DataFrame:
    df, _ = clean_for_training(player_table(spark, sf_dir))
    return df


def engineered(spark, sf_dir, keep: bool = True) -> DataFrame:
    """Clean + the full target-1 feature set (E1, E4, E5, E6). Persisted unless
    the caller reads it only once (``keep=False``): the nulled table that the
    medians were taken from is kept already. The sleep median comes from the same pass as the family medians (the
    sleep column is not imputed, so it is the same number)."""
    df, fill = clean_for_training(player_table(spark, sf_dir), extra_medians=("QtdHorasDormi",))
    out = FE.target1_features(df, fill.extra["QtdHorasDormi"])
    return materialize(out) if keep else out


def linear_pred_sql(coefs: dict, intercept: float) -> str:
    """b + w1·x1 + w2·x2 … evaluated left to right."""
    return plus([sql_lit(float(intercept))] + [f"{sql_lit(float(w))} * {q(c)}" for c, w in coefs.items()])


def linear_pred(coefs: dict, intercept: float):
    return F.expr(linear_pred_sql(coefs, intercept))


def fixed_predictions(df: DataFrame) -> DataFrame:
    """M8 + M13 with the fixed scorers: each target is the mean of three
    members (scaled copies of the scorer) computed in one projection."""
    exprs = {}
    for t, (b, coefs) in FIXED_LINEAR.items():
        members = [linear_pred_sql({c: w * s for c, w in coefs.items()}, b * s) for s in FIXED_ENSEMBLE_SCALE]
        exprs[PRED_NAMES[t]] = F.expr(f"{plus(members)} / {len(members)}")
    return df.withColumns(exprs)


# --------------------------------------------------------------------------
# sources, schema, cleaning
# --------------------------------------------------------------------------

@register("perf_by_priority", "S2 P3 L2 L3 I1 A6 R1 A16")
def perf_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum slice: read → P family → −1 to NULL → exact-median fill →
    row mean → mean per category."""
    df = player_table(spark, sf_dir)
    p = FAM.family(df.columns, "P")
    df = C.apply_to(df, p, lambda c: C.null_sentinel(C.to_number(c, df.schema[c].dataType, as_sql=True)))
    df = materialize(df)
    df = MedianImputer(p).fit(df).transform(df)
    out = (df.withColumn("P_mean", row_mean(p))
           .groupBy("Cor0202")
           .agg(F.avg("P_mean").alias("avg_p_mean"), F.count(F.lit(1)).alias("players")))
    return round6(out)


@register("player_table", "S2")
def q_player_table(spark, sf_dir):
    return round6(player_table(spark, sf_dir))


@register("clean_table", "L1 L2 L3 L5 P3 P7 I1 I3 A6")
def q_clean_table(spark, sf_dir):
    return round6(clean_player(spark, sf_dir))


@register("dedupe_columns", "P1 P2 P8")
def q_dedupe(spark, sf_dir):
    """A frame with repeated headers (as an upload can have), renamed by both rules."""
    from ..sources.schema import dedupe_names
    df = player_table(spark, sf_dir)
    dup = df.select(F.col(ID_COL), F.col("F0103"), F.col("P01"), F.col("F0103"), F.col("P01"), F.col("P01"))
    serving = dedupe_columns(dup, rule="serving")
    train_names = dedupe_names(dup.columns, rule="index_all")
    pos = serving.columns
    return round6(serving.select(*[F.col(c) for c in pos],
                                 *[F.col(pos[i]).alias(f"train_{train_names[i]}") for i in range(1, len(pos))]))


@register("family_profile", "P3 P4 P5 P6 A4")
def q_family_profile(spark, sf_dir):
    """Columns per family/sub-family rule with non-null and skip-answer counts."""
    df = coerce_families(player_table(spark, sf_dir))
    cols = df.columns
    groups = {"P": FAM.family(cols, "P"), "T": FAM.family(cols, "T"), "F": FAM.family(cols, "F"),
              "F_profile": FAM.by_prefix(FAM.family(cols, "F"), FAM.F_PROFILE_PREFIXES),
              "F_sleep_prefix": FAM.by_prefix(FAM.family(cols, "F"), FAM.F_SLEEP_PREFIX),
              "F_final_prefix": FAM.by_prefix(FAM.family(cols, "F"), FAM.F_FINAL_PREFIX),
              "F_sleep_substring": FAM.by_substring(FAM.family(cols, "F"), "07"),
              "F_final_substring": FAM.by_substring(FAM.family(cols, "F"), "11"),
              "late_exact": FAM.group_columns(cols, FAM.LATE_GROUP, "exact"),
              "early_prefix": FAM.group_columns(cols, FAM.EARLY_GROUP, "prefix")}
    conds, rows = {}, []
    for g, members in groups.items():
        for c in members:
            k = len(conds)
            conds[f"__nn{k}"] = PR.col_(c).isNotNull()
            conds[f"__sk{k}"] = PR.col_(c) == -1
            rows.append({"family": F.lit(g), "column": F.lit(c),
                         "non_null": F.col(f"__nn{k}"), "skips": F.col(f"__sk{k}")})
    return PR.to_long(PR.count_where(df, conds), rows)


@register("negative_counts", "L4 A4 P7")
def q_negative_counts(spark, sf_dir):
    """Notebook step: negatives in numeric non-target columns, counted, then NULL."""
    df = coerce_families(player_table(spark, sf_dir))
    num = FAM.numeric_columns(df, exclude=FAM.TARGET_COLUMNS + ID_COLUMNS)
    counts = PR.count_where(df, {c: PR.col_(c) < 0 for c in num})
    rows = [{"column": F.lit(c), "negatives": F.col(f"`{c}`")} for c in num]
    return PR.to_long(counts, rows)


def _negatives_nulled(spark, sf_dir):
    df = coerce_families(player_table(spark, sf_dir))
    num = FAM.numeric_columns(df, exclude=FAM.TARGET_COLUMNS + ID_COLUMNS)
    return C.apply_to(df, num, C.null_negative)


@register("missing_profile", "A1 A2")
def q_missing_profile(spark, sf_dir):
    return PR.missing_profile(_negatives_nulled(spark, sf_dir))


def _with_sparse(df):
    # derived answer present only for one wake slot: far over the 70 % rule
    return df.withColumn("P16", F.when(F.col("Acordar") == 0, F.col("P01")))


@register("drop_sparse_columns", "A3 P8")
def q_drop_sparse(spark, sf_dir):
    df = _with_sparse(_negatives_nulled(spark, sf_dir))
    prof = PR.missing_profile(df)
    return prof.withColumn("removed", F.col("Percentual") > 70.0)


@register("sparse_columns_dropped", "A3 P8")
def q_sparse_dropped(spark, sf_dir):
    """The reduced table itself; targets and the id are protected."""
    df = _with_sparse(_negatives_nulled(spark, sf_dir))
    return round6(PR.drop_sparse(df, protect=TARGETS + (ID_COL,)))


@register("filter_targets", "F1 F2 F3")
def q_filter_targets(spark, sf_dir):
    df = player_table(spark, sf_dir)
    any_target = df.dropna(how="all", subset=list(TARGETS))
    return any_target.select(ID_COL, F.col("Target1").isNotNull().alias("has_target1"),
                             F.when(F.col("Target2") > 100, "high").otherwise("normal").alias("t2_band"))


@register("skip_rates", "A5")
def q_skip_rates(spark, sf_dir):
    """Reference mode: one scalar per family (−1 cells / number of columns)."""
    from .prepare import skip_rate_summary
    df = guard_ranges(coerce_families(player_table(spark, sf_dir)))
    return round6(skip_rate_summary(df))


@register("skip_rates_row", "A5")
def q_skip_rates_row(spark, sf_dir):
    df = guard_ranges(coerce_families(player_table(spark, sf_dir)))
    return round6(skip_rates(df, mode="row").select(ID_COL, "taxa_pulos_P", "taxa_pulos_T", "taxa_pulos_geral"))


@register("median_values", "A6 I1")
def q_median_values(spark, sf_dir):
    """Fitted imputation values as a parameter table (S7 layout)."""
    df = materialize(nulled_player(spark, sf_dir))
    fam = FAM.all_family_columns(df.columns)
    med = MedianImputer(fam).fit(df)
    rows = [{"column": F.lit(c), "median": F.lit(v).cast("double")} for c, v in med.values.items()]
    return round6(PR.to_long(spark.range(1), rows))


@register("mode_impute", "I2 A7")
def q_mode_impute(spark, sf_dir):
    df = materialize(nulled_player(spark, sf_dir))
    cats = [c for c in FAM.CATEGORICAL_COLUMNS if c in df.columns]
    model = ModeImputer(cats).fit(df)
    return round6(model.transform(df).select(ID_COL, *cats))


@register("iqr_outliers", "I4 A8 F3")
def q_iqr_outliers(spark, sf_dir):
    df, _ = clean_for_training(player_table(spark, sf_dir))
    df = materialize(df)
    cols = [c for c in FAM.numeric_columns(df, exclude=FAM.TARGET_COLUMNS + ID_COLUMNS)
            if c not in FAM.SLEEP_COLUMNS and c not in FAM.CATEGORICAL_COLUMNS]
    model = IQROutlierClipper(cols).fit(df)
    return round6(model.transform(df).select(ID_COL, *cols))


@register("outlier_counts", "I4 A4 A8")
def q_outlier_counts(spark, sf_dir):
    df, _ = clean_for_training(player_table(spark, sf_dir))
    df = materialize(df)
    cols = [c for c in FAM.numeric_columns(df, exclude=FAM.TARGET_COLUMNS + ID_COLUMNS)
            if c not in FAM.SLEEP_COLUMNS and c not in FAM.CATEGORICAL_COLUMNS]
    model = IQROutlierClipper(cols).fit(df)
    counts = model.count_outliers(df)
    rows = [{"column": F.lit(c), "lower": F.lit(model.bounds[c][0]).cast("double"),
             "upper": F.lit(model.bounds[c][1]).cast("double"), "outliers": F.col(f"`{c}`")} for c in cols]
    return round6(PR.to_long(counts, rows))


@register("one_hot", "I5 P11")
def q_one_hot(spark, sf_dir):
    df = player_table(spark, sf_dir)
    cats = ["Cor0202", "Cor0204"]
    model = OneHotEncoder(cats).fit(df)
    enc = model.transform(df.select(ID_COL, *cats))
    return SEL.melt(enc, [ID_COL], model.output_columns(), "dummy", "flag")


@register("one_hot_sparse", "I5")
def q_one_hot_sparse(spark, sf_dir):
    """Every categorical column present, in the long form without a level list."""
    from ..operators.encode import indicators
    df = player_table(spark, sf_dir)
    return indicators(df, ID_COL, [c for c in FAM.CATEGORICAL_COLUMNS if c in df.columns])


@register("row_id", "P13")
def q_row_id(spark, sf_dir):
    """Id column if present (as text); else a running number, unique per row."""
    from ..sources.schema import row_id
    df = player_table(spark, sf_dir).select(F.col(ID_COL).alias(FAM.ID_COLUMN))
    named = row_id(df).select("__row_id")
    made = row_id(df.select(F.lit(1).alias("x"))).select("__row_id")
    return (named.agg(F.count("*").alias("rows"), F.countDistinct("__row_id").alias("ids"), F.min("__row_id").alias("least"))
            .withColumn("kind", F.lit("given"))
            .unionByName(made.agg(F.count("*").alias("rows"), F.countDistinct("__row_id").alias("ids"), F.min("__row_id").alias("least"))
                         .withColumn("kind", F.lit("running"))))


# --------------------------------------------------------------------------
# row statistics and engineered features
# --------------------------------------------------------------------------

@register("row_stats", "R1 R2 R3 R4 R5 R6 N5")
def q_row_stats(spark, sf_dir):
    df = nulled_player(spark, sf_dir)
    p, t = FAM.family(df.columns, "P"), FAM.family(df.columns, "T")
    out = with_row_stats(df, {"P_mean": ("mean", p), "P_std": ("std", p), "P_min": ("min", p),
                              "P_max": ("max", p), "T_total": ("sum", t), "T_std": ("std", t)})
    out = out.withColumn("P_range", F.col("P_max") - F.col("P_min"))
    return round6(out.select(ID_COL, "P_mean", "P_std", "P_min", "P_max", "P_range", "T_total", "T_std"))


@register("guarded_group_means", "R7 R8 P6")
def q_guarded(spark, sf_dir):
    df = nulled_player(spark, sf_dir)
    f = FAM.family(df.columns, "F")
    f11, f07 = FAM.by_prefix(f, "F11"), FAM.by_prefix(f, "F07")
    exprs = {}
    if len(f11) > 2:
        exprs["F11_mean"] = row_mean(f11)
    if len(f07) > 2:
        exprs["F07_mean"] = row_mean(f07)
    spec = FE.performance_spec(df.columns, "exact")
    exprs["P_late"] = row_mean(spec["P_late"][1])
    exprs["P_early"] = row_mean(spec["P_early"][1])
    no15 = df.drop("P15")
    exprs["P_late_without_p15"] = row_mean(FE.performance_spec(no15.columns, "exact")["P_late"][1])
    exprs["P_late_prefix_without_p15"] = row_mean(FE.performance_spec(no15.columns, "prefix")["P_late"][1])
    return round6(df.select(ID_COL, *[v.alias(k) for k, v in exprs.items()]))


@register("features_target1", "E1 E4 E5 E6 L8 R1 R2 R3 R4 R5 R8 A6")
def q_features_t1(spark, sf_dir):
    df = engineered(spark, sf_dir, keep=False)
    base = set(PLAYER_COLUMNS)
    new = [c for c in df.columns if c not in base]
    return round6(df.select(ID_COL, *new))


@register("features_target2", "E2 E6 R1")
def q_features_t2(spark, sf_dir):
    df = FE.target2_features(clean_player(spark, sf_dir))
    return round6(df.select(ID_COL, "sono_total", "acordar", "F_sono_mean", "F_final_mean", "P_mean"))


@register("features_target3", "E3 E4 E5 E10 P5 R1 R2 R4")
def q_features_t3(spark, sf_dir):
    df = clean_player(spark, sf_dir).withColumn("QtdHorasSono", F.col("QtdHorasDormi") + 1)
    df = FE.named_interaction(FE.target3_features(df), "F1103", "P_mean")
    cols = ["P_mean", "P_std", "P_late", "P_early", "T_mean", "T_std", "F_sono_mean", "F_sono_std",
            "F_sono_max", "sono_x_acordar", "acordar_squared", "F_final_mean", "F1103_X_P_mean"]
    return round6(df.select(ID_COL, *cols))


@register("features_cluster", "E7 R6")
def q_features_cluster(spark, sf_dir):
    df = FE.cluster_features(clean_player(spark, sf_dir))
    return round6(df.select(ID_COL, "P_mean", "P_std", "P_max", "T_mean", "T_total", "F_sono_mean", "F_final_mean"))


def _feature_pool(df):
    return FAM.numeric_columns(df, exclude=FAM.TARGET_COLUMNS + ID_COLUMNS)


@register("variance_filter", "A9 K1 L6")
def q_variance(spark, sf_dir):
    df = engineered(spark, sf_dir)
    return round6(PR.variance_table(df, _feature_pool(df), fill_zero=True, threshold=0.01))


@register("corr_rank_target1", "A10 K2 N3 N4")
def q_corr_rank(spark, sf_dir):
    df = engineered(spark, sf_dir)
    ranked = SEL.variance_corr_ranking(df, _feature_pool(df), "Target1", 0.01)
    return round6(ranked.filter(F.col("rank") <= 30))


@register("corr_rank_target2", "A10 K2")
def q_corr_rank2(spark, sf_dir):
    df = engineered(spark, sf_dir)
    return round6(SEL.corr_ranking(df, _feature_pool(df), "Target2").filter(F.col("rank") <= 12))


@register("corr_select_target3", "K3")
def q_corr_select_t3(spark, sf_dir):
    df = engineered(spark, sf_dir)
    r = SEL.corr_ranking(df, _feature_pool(df), "Target3").filter(F.col("abs_corr") > 0.35)
    return round6(r.filter(F.col("rank") <= 15))


@register("corr_report", "A11 A12 K4")
def q_corr_report(spark, sf_dir):
    df = engineered(spark, sf_dir)
    return round6(PR.corr_report(df, _feature_pool(df), list(TARGETS), threshold=0.20))


@register("corr_top10", "K5")
def q_corr_top10(spark, sf_dir):
    df = engineered(spark, sf_dir)
    rep = PR.corr_report(df, _feature_pool(df), list(TARGETS), threshold=0.20)
    return round6(SEL.top_report(rep, "Corr_Media", 10).select("Feature", "Corr_Media", "rank"))


@register("corr_matrix", "A13")
def q_corr_matrix(spark, sf_dir):
    df = engineered(spark, sf_dir)
    return round6(PR.corr_matrix(df, ["P_mean", "T_mean", "F_mean_geral", "sono_total", "Target1", "Target3"]))


@register("corr_matrix_all", "A10 A13 P7")
def q_corr_matrix_all(spark, sf_dir):
    """A13 over every numeric feature and target, from one scan."""
    from ..operators.crossmoments import corr_tiles
    df = engineered(spark, sf_dir, keep=False)
    return round6(corr_tiles(df, [*FAM.numeric_columns(df, exclude=(ID_COL, *TARGETS)), *TARGETS]))


@register("describe", "A14 A6 A8")
def q_describe(spark, sf_dir):
    df = engineered(spark, sf_dir)
    return round6(PR.describe(df, ["Target1", "Target2", "Target3", "P_mean", "T_mean", "F0103"]))


@register("interactions_target1", "E8 E9 K6")
def q_interactions(spark, sf_dir):
    df = engineered(spark, sf_dir)
    top = SEL.variance_corr_ranking(df, _feature_pool(df), "Target1", 0.01).filter(F.col("rank") <= 30)
    ranked = [r["feature"] for r in top.orderBy("rank").collect()]
    names = FE.interaction_names(ranked, 3)
    names2 = FE.interaction_names(ranked, 2)
    feats = FAM.ordered_unique(ranked + names + names2)
    inter = [n for n in feats if "_X_" in n]
    out = FE.add_interactions(df, inter).select(ID_COL, *inter)
    return round6(SEL.melt(out, [ID_COL], inter, "interaction", "value"))


# --------------------------------------------------------------------------
# scaling, splitting, alignment
# --------------------------------------------------------------------------

SCALE_COLS = ["P_mean", "T_mean", "F_mean_geral", "sono_total", "F0103", "Cor0202_1-URGENT"]


@register("standard_scaled", "Z1 Z4")
def q_standard(spark, sf_dir):
    df = engineered(spark, sf_dir).withColumn("Cor0202_1-URGENT", F.col("Cor0202") == "1-URGENT")
    df = bool_to_int(df)
    onehot = FAM.one_hot_columns(SCALE_COLS, rule="prefix")
    num = [c for c in SCALE_COLS if c not in onehot]
    out = StandardScaler(num).fit(df).transform(df)
    return round6(out.select(ID_COL, *[F.col(f"`{c}`") for c in SCALE_COLS]))


@register("robust_scaled", "Z2 L6")
def q_robust(spark, sf_dir):
    df = engineered(spark, sf_dir)
    cols = ["P_mean", "T_mean", "F_mean_geral", "sono_irregular", "F0103"]
    filled = df.select(ID_COL, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols])
    filled = materialize(filled)
    return round6(RobustScaler(cols).fit(filled).transform(filled))


@register("split_assign", "X1")
def q_split(spark, sf_dir):
    df = player_table(spark, sf_dir).filter(F.col("Target1").isNotNull())
    return df.select(ID_COL, *[split_flag(ID_COL, s, 25).alias(f"split_{s}") for s in (42, 123, 456)],
                     split_flag(ID_COL, 42, 20).alias("split80_42"))


@register("kfold_assign", "X2")
def q_kfold(spark, sf_dir):
    df = player_table(spark, sf_dir).select(ID_COL)
    df = kfold(df, ID_COL, 5, 42, "fold5")
    return kfold(df, ID_COL, 3, 42, "fold3")


@register("align_features", "P9 P10 P12")
def q_align(spark, sf_dir):
    df = engineered(spark, sf_dir, keep=False)
    trained = ["T_mean", "P_mean", "not_in_upload", "sono_x_acordar", "P_mean_X_T_mean"]
    df = FE.add_interactions(df, ["P_mean_X_T_mean"])
    return round6(align_to(df, trained, keep=[ID_COL]))


# --------------------------------------------------------------------------
# scoring, metrics, explanation (fixed linear scorers)
# --------------------------------------------------------------------------

def scored(spark, sf_dir, keep: bool = True) -> DataFrame:
    return fixed_predictions(engineered(spark, sf_dir, keep))


@register("ensemble_predictions", "M8 M13")
def q_ensemble(spark, sf_dir):
    df = scored(spark, sf_dir, keep=False)
    return round6(df.select(ID_COL, *PRED_NAMES.values()))


@register("prediction_output", "M13 L7 L11 P12 S8")
def q_prediction_output(spark, sf_dir):
    df = scored(spark, sf_dir, keep=False)
    return df.select(C.id_string(ID_COL).alias("Código de Acesso"),
                     *[C.round_half_even(p, 2).alias(f"Previsão T{i + 1}")
                       for i, p in enumerate(PRED_NAMES.values())])


@register("metrics_by_split", "M9 M10 M11 X1")
def q_metrics(spark, sf_dir):
    """Every (target, split) metric in one global aggregate (one scan, one
    partial row per task), reshaped to one row per target."""
    df = scored(spark, sf_dir, keep=False).withColumn("split", split_flag(ID_COL, 42, 25))
    aggs = []
    for i, (t, p) in enumerate(PRED_NAMES.items()):
        for sp in ("train", "test"):
            aggs += metric_aggs(t, p, prefix=f"__{sp}{i}_", where=F.col("split") == sp)
    one = df.agg(*aggs)
    rows = [{"target": sql_lit(t), "r2_train": f"__train{i}_r2", "r2_test": f"__test{i}_r2",
             "mae_test": f"__test{i}_mae", "rmse_test": f"__test{i}_rmse", "mape_test": f"__test{i}_mape",
             "n_test": f"__test{i}_n"} for i, t in enumerate(PRED_NAMES)]
    out = PR.to_long(one, rows)
    return round6(out.withColumn("overfitting_pct", overfitting_pct(F.col("r2_train"), F.col("r2_test"))))


@register("metrics_report", "M16 S6 L9")
def q_metrics_report(spark, sf_dir):
    """The metrics of all three targets go through the metrics store; the
    report joins them to friendly names, and a target without a record gives a
    NULL row (the 'missing file tolerated' case)."""
    from ..session import scratch_path
    from ..sources.sinks import load_metrics, save_metrics
    df = scored(spark, sf_dir)
    row = df.agg(*[a for i, (t, p) in enumerate(PRED_NAMES.items()) for a in metric_aggs(t, p, prefix=f"__m{i}_")]).first()
    records = {t: {"r2_test": row[f"__m{i}_r2"], "mae_test": row[f"__m{i}_mae"], "rmse_test": row[f"__m{i}_rmse"],
                   "n_features": len(FIXED_LINEAR[t][1])} for i, t in enumerate(PRED_NAMES)}
    path = scratch_path(spark, f"metrics-{uuid.uuid4().hex}")
    save_metrics(spark, records, path)
    names = spark.createDataFrame([("Target1", "R1 (Performance)"), ("Target2", "R2 (Variável)"),
                                   ("Target3", "R3 (Formulários)"), ("Target4", "não encontrado")], "target string, name string")
    stored = load_metrics(spark, path, targets=("Target1", "Target2", "Target3", "Target4"))
    return round6(names.join(stored, "target").select("name", "target", "r2_test", "mae_test", "rmse_test", "n_features"))


def contributions(df: DataFrame, means=None) -> DataFrame:
    """M15 (linear): coef·(x − mean(x)) per feature, long form; with the
    ensemble of scaled members the mean contribution is the scale mean × it."""
    s = sum(FIXED_ENSEMBLE_SCALE) / len(FIXED_ENSEMBLE_SCALE)
    feats = sorted({c for _, coefs in FIXED_LINEAR.values() for c in coefs})
    means = means or df.agg(*[F.expr(f"avg({q(c)})").alias(c) for c in feats]).first()
    structs = []
    for t, (_, coefs) in FIXED_LINEAR.items():
        for c, w in coefs.items():
            structs.append(f"named_struct('target', {sql_lit(t)}, 'feature', {sql_lit(c)}, "
                           f"'value', {sql_lit(float(w * s))} * ({q(c)} - {sql_lit(means[c])}))")
    return df.selectExpr(q(ID_COL), f"inline(array({', '.join(structs)}))")


@register("linear_contributions", "M15")
def q_contrib(spark, sf_dir):
    return round6(contributions(engineered(spark, sf_dir)))


def wide_scorer(columns) -> dict:
    """A fixed linear scorer over a whole feature list: the weight of the
    feature at place i in name order is (i mod 7 + 1) / 7, with alternating sign."""
    return {c: (i % 7 + 1) / 7 * (-1) ** i for i, c in enumerate(sorted(columns))}


@register("top_contributions", "K8")
def q_top_contrib(spark, sf_dir):
    """The 15 largest of all features' contributions per player. The features
    are a projection of the kept nulled table, cheaper twice than stored once."""
    df = engineered(spark, sf_dir, keep=False)
    weights = wide_scorer(_feature_pool(df))
    means = df.agg(*[F.expr(f"avg({q(c)})").alias(c) for c in weights]).first()
    values = {c: f"{sql_lit(float(w))} * ({q(c)} - {sql_lit(means[c])})" for c, w in weights.items() if means[c] is not None}
    return round6(SEL.top_contributions(df, {"Target1": values}, k=15))


@register("lookup_player", "F5 F4")
def q_lookup(spark, sf_dir):
    df = scored(spark, sf_dir)
    first_id = df.agg(F.min(ID_COL)).first()[0]
    return round6(df.filter(F.col(ID_COL) == first_id).select(ID_COL, *PRED_NAMES.values()))


@register("history_replay", "S5")
def q_history_replay(spark, sf_dir):
    """Two batches of one run, one of them written twice, and a batch of
    another run with the same number: the history keeps each batch once."""
    from ..session import scratch_path
    from ..sources.sinks import append_history, read_history
    preds = materialize(scored(spark, sf_dir, keep=False).select(
        F.col(ID_COL).alias("Código de Acesso"), *[C.round_half_even(p, 2).alias(f"Previsão T{i + 1}") for i, p in enumerate(PRED_NAMES.values())]))
    path, even = scratch_path(spark, f"history-{uuid.uuid4().hex}"), F.col("`Código de Acesso`") % 2 == 0
    for run, batch, rows in (("a", 0, preds.filter(even)), ("a", 1, preds.filter(~even)), ("a", 1, preds.filter(~even)), ("b", 0, preds.filter(~even))):
        append_history(rows, path, user_id=1, run_id=run, batch_id=batch)
    preds.unpersist()
    hist = read_history(spark, path)
    return round6(hist.groupBy("run_id", "batch_id").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"),
                                                         F.avg("pred_t2").alias("avg_t2")))


@register("lookup_history", "F5 F4 S5")
def q_lookup_history(spark, sf_dir):
    """One player from the stored history (the filter reaches the scan), with
    the contributions behind each prediction."""
    from ..session import scratch_path
    from ..sources.sinks import append_history, read_history
    df = materialize(scored(spark, sf_dir))
    path = scratch_path(spark, f"history-{uuid.uuid4().hex}")
    append_history(df.select(F.col(ID_COL).alias("Código de Acesso"), *[
        F.col(p).alias(f"Previsão T{i + 1}") for i, p in enumerate(PRED_NAMES.values())]), path, user_id=1, run_id="a")
    found = read_history(spark, path).filter("user_id = 1 AND jogador_id = '7'")
    long = found.select("jogador_id", F.expr("inline(array(" + ", ".join(
        f"named_struct('target', '{t}', 'prediction', {p})" for t, p in PRED_NAMES.items()) + "))"))
    means = df.agg(*[F.avg(c).alias(c) for c in {c for _, w in FIXED_LINEAR.values() for c in w}]).first()
    mine = contributions(df.filter(F.col(ID_COL) == 7), means).select("target", "feature", "value")
    return round6(long.join(mine, "target"))


@register("kpis", "A19")
def q_kpis(spark, sf_dir):
    df = scored(spark, sf_dir, keep=False)
    return round6(df.agg(F.count(F.lit(1)).alias("players"),
                         *[F.avg(p).alias(f"avg_{p}") for p in PRED_NAMES.values()]))


@register("prediction_histogram", "A20 A22")
def q_hist(spark, sf_dir):
    return round6(PR.histogram(scored(spark, sf_dir), list(PRED_NAMES.values()), bins=20))


@register("prediction_boxplot", "A21 A8")
def q_box(spark, sf_dir):
    return round6(PR.five_numbers(scored(spark, sf_dir), list(PRED_NAMES.values())))


@register("column_min_max", "A22")
def q_minmax(spark, sf_dir):
    df = engineered(spark, sf_dir)
    cols = ["QtdHorasDormi", "Acordar", "F0103", "Target1", "Target2", "Target3"]
    rows = [{"column": F.lit(c), "min": F.col(f"lo{i}"), "max": F.col(f"hi{i}")} for i, c in enumerate(cols)]
    one = df.agg(*[e for i, c in enumerate(cols) for e in (F.min(c).cast("double").alias(f"lo{i}"),
                                                             F.max(c).cast("double").alias(f"hi{i}"))])
    return round6(PR.to_long(one, rows))


@register("melt_predictions", "U1")
def q_melt(spark, sf_dir):
    df = scored(spark, sf_dir, keep=False).select(ID_COL, *PRED_NAMES.values())
    return round6(SEL.melt(df, [ID_COL], list(PRED_NAMES.values()), "target", "prediction"))


@register("page_predictions", "K9")
def q_page(spark, sf_dir):
    df = scored(spark, sf_dir, keep=False).select(ID_COL, *PRED_NAMES.values())
    return round6(SEL.page(df, [F.desc("pred_t1"), F.asc(ID_COL)], where=F.col("pred_t2") > 100,
                           limit=25, offset=10))


# --------------------------------------------------------------------------
# fitted closed-form models (checkable in SQL)
# --------------------------------------------------------------------------

@register("ols_one_feature", "M1 X1")
def q_ols(spark, sf_dir):
    """OLS of each target on P_mean over the training split (MLlib normal solver)."""
    from ..operators.models import fit_linear
    df = engineered(spark, sf_dir).withColumn("split", split_flag(ID_COL, 42, 25))
    train = df.filter(F.col("split") == "train")
    rows = []
    for t in TARGETS:
        m = fit_linear(train.filter(F.col(t).isNotNull()), ["P_mean"], t)
        rows.append((t, float(m.coefficients[0]), float(m.intercept)))
    out = spark.createDataFrame(rows, "target string, slope double, intercept double")
    return round6(out)


@register("loo_linear", "M12 M9")
def q_loo(spark, sf_dir):
    """Exact leave-one-out of the 1-feature OLS via the hat diagonal, on all
    rows and with the feature missing in a fifth of them."""
    df = engineered(spark, sf_dir)
    rows = []
    for case, x in (("all", "P_mean"), ("missing", "__part")):
        data = df.withColumn("__part", F.when(F.col("Acordar") != 0, F.col("P_mean")))
        for t in TARGETS:
            r = linear_loo(data, [x], t)
            rows.append((case, t, r["r2_loo"], r["mae_loo"], r["rmse_loo"], r["n"]))
    return round6(spark.createDataFrame(rows, "case string, target string, r2_loo double, mae_loo double, rmse_loo double, n long"))


@register("saved_plan_scoring", "S7 M13 M1 P9 E8 E10 Z2")
def q_saved_plan(spark, sf_dir):
    """Two targets with their own preparation (features, product, alignment,
    robust scaler) and least squares, saved, loaded into a fresh plan and
    applied; the third target has no model and stays NULL."""
    from ..session import scratch_path
    from .scoring import TargetModel, fit_scoring_plan, score
    from .state import load_state, save_state
    raw = player_table(spark, sf_dir)
    plan = fit_scoring_plan(raw, targets=(
        TargetModel("Target1", 1, ["P_mean", "P_mean_X_T_mean"], ["P_mean_X_T_mean"]),
        TargetModel("Target3", 3, ["T_mean", "F1103_X_P_mean"], ["F1103_X_P_mean"])))
    path = scratch_path(spark, f"plan-{uuid.uuid4().hex}")
    save_state(spark, plan, path)
    return score(raw, load_state(spark, path), ID_COL)


@register("split_exact", "X1")
def q_split_exact(spark, sf_dir):
    """Splits of exact size for the three seeds (20 % once, 25 % twice)."""
    df = player_table(spark, sf_dir).select(ID_COL)
    flags = {f"split_{s}": exact_split_flag(df, ID_COL, s, share) for s, share in ((42, 0.2), (123, 0.25), (456, 0.25))}
    return df.select(ID_COL, *[f.alias(n) for n, f in flags.items()])


@register("three_target_scoring", "M13 S7 M1 P9 E2 E8 E10 Z2 Z3 L7")
def q_three_targets(spark, sf_dir):
    """One scoring call with the three targets' own preparations: products and
    robust scaling (1 and 3), sleep set B with the quantile-normal scaler (2),
    least squares each; saved and loaded before it is applied."""
    from ..session import scratch_path
    from .scoring import TargetModel, fit_scoring_plan, score
    from .state import load_state, save_state
    raw = player_table(spark, sf_dir)
    plan = fit_scoring_plan(raw, targets=(
        TargetModel("Target1", 1, ["P_mean", "P_mean_X_T_mean"], ["P_mean_X_T_mean"]),
        TargetModel("Target2", 2, ["P_mean"], quantiles=11),
        TargetModel("Target3", 3, ["T_mean", "F1103_X_P_mean"], ["F1103_X_P_mean"])))
    path = scratch_path(spark, f"plan-{uuid.uuid4().hex}")
    save_state(spark, plan, path)
    return score(raw, load_state(spark, path), ID_COL)


# --------------------------------------------------------------------------
# clustering with fixed centroids / loadings
# --------------------------------------------------------------------------

def standardized_cluster(spark, sf_dir):
    """Scored frame and the cluster model on it: standardized features (Z1),
    fixed centroids and loadings, saved and loaded like any fitted state. The
    E7 features already exist on the engineered frame, so predictions, raw
    score and cluster inputs stay on one frame — no join back."""
    from ..operators.cluster import ClusterModel
    from ..session import scratch_path
    from .state import load_state, save_state
    df = scored(spark, sf_dir).withColumn("raw_p_mean", F.col("P_mean"))
    cols = list(FE.CLUSTER_FEATURES)
    path = scratch_path(spark, f"cluster-{uuid.uuid4().hex}")
    save_state(spark, ClusterModel(cols, StandardScaler(cols).fit(df), FIXED_CENTROIDS, FIXED_LOADINGS), path)
    return df, load_state(spark, path)


def assign_fixed(df, model):
    return model.transform(df)


@register("cluster_assign", "C2 Z1 E7")
def q_cluster_assign(spark, sf_dir):
    df, model = standardized_cluster(spark, sf_dir)
    return assign_fixed(df, model).select(ID_COL, "cluster")


@register("pca_project", "C3 Z1")
def q_pca(spark, sf_dir):
    df, model = standardized_cluster(spark, sf_dir)
    return round6(assign_fixed(df, model).select(ID_COL, "pc1", "pc2"))


@register("cluster_names", "C5 A16")
def q_cluster_names(spark, sf_dir):
    from ..operators.cluster import name_clusters
    df, model = standardized_cluster(spark, sf_dir)
    return round6(name_clusters(assign_fixed(df, model), "cluster", "raw_p_mean"))


@register("cluster_report", "A17 A18 C6 L9")
def q_cluster_report(spark, sf_dir):
    from ..operators.cluster import cluster_report
    df, model = standardized_cluster(spark, sf_dir)
    out = assign_fixed(df, model)
    # names come from the report's own per-cluster aggregate (one grouping)
    return round6(cluster_report(out, "cluster", "raw_p_mean", list(PRED_NAMES.values())))


# --------------------------------------------------------------------------
# history (prediction fact table, from the events table)
# --------------------------------------------------------------------------

@register("history_by_upload", "A15 L10 F4")
def q_history(spark, sf_dir):
    from ..sources.sinks import history_from_events, history_counts
    hist = history_from_events(spark, sf_dir)
    return history_counts(hist, user_id=8)
