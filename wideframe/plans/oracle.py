"""DuckDB oracle SQL, one string per registered query.

Column lists are written out here by hand (the stand-in table's layout is
fixed), so the oracle checks the library's family rules as well as its
arithmetic.
"""

from __future__ import annotations

from . import sqlgen as S
from .catalog import FIXED_CENTROIDS, FIXED_ENSEMBLE_SCALE, FIXED_LINEAR, FIXED_LOADINGS, PRED_NAMES
from .sqlgen import qi, r6, with_player

ORACLE: dict[str, str] = {}

P = ["P01", "P02", "P03", "P04", "P09", "P12", "P13", "P15"]
T = ["T01", "T02", "T03", "T04"]
FX = ["F0101", "F0701", "F0702", "F1101", "F1102", "F1103"]
PIV = P + T + FX
FAMC = ["F0103"] + P + T + FX                      # family columns in schema order
NUM = ["F0103", "QtdHorasDormi", "Acordar"] + PIV   # numeric, non-target, non-id
TGT = ["Target1", "Target2", "Target3"]
F_ALL = ["F0103"] + FX
LATE = ["P09", "P12", "P13", "P15"]
EARLY = ["P01", "P02", "P03", "P04"]


def cols(cs):
    return ", ".join(qi(c) for c in cs)


def rounded(cs):
    return ", ".join(f"round({qi(c)}, 6) AS {qi(c)}" for c in cs)


C1 = (f"c1 AS (SELECT player_id, Cor0202, Cor0204, TRY_CAST(replace(F0103, ',', '.') AS DOUBLE) AS F0103, "
      f"QtdHorasDormi, Acordar, {cols(PIV)}, {cols(TGT)} FROM player)")
C2 = ("c2 AS (SELECT player_id, Cor0202, Cor0204, "
      + ", ".join(f"CASE WHEN {qi(c)} >= -100 AND {qi(c)} <= 10000 THEN {qi(c)} END AS {qi(c)}" for c in NUM)
      + f", {cols(TGT)} FROM c1)")
NULLED = ("nulled AS (SELECT player_id, Cor0202, Cor0204, QtdHorasDormi, Acordar, "
          + ", ".join(f"CASE WHEN {qi(c)} <> -1 THEN {qi(c)} END AS {qi(c)}" for c in FAMC)
          + f", {cols(TGT)} FROM c2)")
MED = "med AS (SELECT " + ", ".join(f"median({qi(c)}) AS {qi('m_' + c)}" for c in FAMC) + " FROM nulled)"
CLEAN = ("clean AS (SELECT player_id, Cor0202, Cor0204, QtdHorasDormi, Acordar, "
         + ", ".join(f"coalesce({qi(c)}, {qi('m_' + c)}) AS {qi(c)}" for c in FAMC)
         + f", {cols(TGT)} FROM nulled, med)")


def _t1_features() -> dict:
    d = {
        "sono_total": "QtdHorasDormi",
        "sono_x_acordar": "QtdHorasDormi * Acordar",
        "sono_squared": "QtdHorasDormi * QtdHorasDormi",
        "sono_irregular": "abs(QtdHorasDormi - sleep_med)",
        "P_mean": S.row_mean(P), "P_std": S.row_std(P), "P_min": S.row_min(P), "P_max": S.row_max(P),
        "P_range": f"({S.row_max(P)} - {S.row_min(P)})",
        "P_late": S.row_mean(LATE), "P_early": S.row_mean(EARLY),
        "T_mean": S.row_mean(T), "T_std": S.row_std(T), "T_min": S.row_min(T), "T_max": S.row_max(T),
        "F_perfil_mean": S.row_mean(["F0103", "F0101"]), "F_perfil_std": S.row_std(["F0103", "F0101"]),
        "F_sono_mean": S.row_mean(["F0701", "F0702"]), "F_sono_std": S.row_std(["F0701", "F0702"]),
        "F_final_mean": S.row_mean(["F1101", "F1102", "F1103"]),
        "F_final_std": S.row_std(["F1101", "F1102", "F1103"]),
        "F_mean_geral": S.row_mean(F_ALL),
    }
    return d


T1F = _t1_features()
ENG = ("eng AS (SELECT clean.*, " + ", ".join(f"{v} AS {qi(k)}" for k, v in T1F.items())
       + " FROM clean, (SELECT median(QtdHorasDormi) AS sleep_med FROM clean) sm)")
POOL = ["F0103", "QtdHorasDormi", "Acordar"] + PIV + list(T1F)   # numeric features of eng


def eng_prefix(*extra):
    return with_player(C1, C2, NULLED, MED, CLEAN, ENG, *extra)


# --------------------------------------------------------------------------

ORACLE["perf_by_priority"] = with_player(
    f"c AS (SELECT Cor0202, {', '.join(f'CASE WHEN {qi(c)} <> -1 THEN {qi(c)} END AS {qi(c)}' for c in P)} FROM player)",
    "m AS (SELECT " + ", ".join(f"median({qi(c)}) AS m_{c}" for c in P) + " FROM c)",
    "i AS (SELECT Cor0202, " + ", ".join(f"coalesce({qi(c)}, m_{c}) AS {qi(c)}" for c in P) + " FROM c, m)",
) + f"SELECT Cor0202, {r6('avg(' + S.row_mean(P) + ')')} AS avg_p_mean, count(*) AS players FROM i GROUP BY Cor0202"

ORACLE["player_table"] = with_player() + (
    f"SELECT player_id, Cor0202, Cor0204, F0103, {rounded(['QtdHorasDormi', 'Acordar'] + PIV + TGT)} FROM player")

ORACLE["clean_table"] = with_player(C1, C2, NULLED, MED, CLEAN) + (
    f"SELECT player_id, Cor0202, Cor0204, {rounded(['QtdHorasDormi', 'Acordar'] + FAMC + TGT)} FROM clean")

ORACLE["dedupe_columns"] = with_player() + (
    "SELECT player_id, F0103, round(P01, 6) AS P01, F0103 AS F0103_v2, round(P01, 6) AS P01_v2, "
    "round(P01, 6) AS P01_v3, F0103 AS train_F0103_0, round(P01, 6) AS train_P01_0, F0103 AS train_F0103_1, "
    "round(P01, 6) AS train_P01_1, round(P01, 6) AS train_P01_2 FROM player")

_FAMILY_GROUPS = {
    "P": P, "T": T, "F": F_ALL, "F_profile": ["F0103", "F0101"], "F_sleep_prefix": ["F0701", "F0702"],
    "F_final_prefix": ["F1101", "F1102", "F1103"], "F_sleep_substring": ["F0701", "F0702"],
    "F_final_substring": ["F1101", "F1102", "F1103"], "late_exact": LATE, "early_prefix": EARLY,
}
ORACLE["family_profile"] = with_player(C1) + "\nUNION ALL\n".join(
    f"SELECT '{g}' AS family, '{c}' AS \"column\", count({qi(c)}) AS non_null, count_if({qi(c)} = -1) AS skips FROM c1"
    for g, members in _FAMILY_GROUPS.items() for c in members)

ORACLE["negative_counts"] = with_player(C1) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count_if({qi(c)} < 0) AS negatives FROM c1" for c in NUM)

NEG = ("neg AS (SELECT player_id, Cor0202, Cor0204, "
       + ", ".join(f"CASE WHEN {qi(c)} >= 0 THEN {qi(c)} END AS {qi(c)}" for c in NUM)
       + f", {cols(TGT)} FROM c1)")
ALLCOLS = ["player_id", "Cor0202", "Cor0204"] + NUM + TGT


def _missing_sql(src, columns):
    body = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS Coluna, count_if({qi(c)} IS NULL) AS Missing, "
        f"round(count_if({qi(c)} IS NULL) * 100.0 / count(*), 2) AS Percentual FROM {src}" for c in columns)
    return f"SELECT * FROM ({body}) WHERE Missing > 0"


ORACLE["missing_profile"] = with_player(C1, NEG) + _missing_sql("neg", ALLCOLS)

ORACLE["drop_sparse_columns"] = with_player(
    C1, NEG, "sp AS (SELECT neg.*, CASE WHEN Acordar = 0 THEN P01 END AS P16 FROM neg)") + (
    f"SELECT *, Percentual > 70.0 AS removed FROM ({_missing_sql('sp', ALLCOLS + ['P16'])})")

# sparse in this layout: only the derived P16
ORACLE["sparse_columns_dropped"] = with_player(C1, NEG) + (
    f"SELECT player_id, Cor0202, Cor0204, {rounded(NUM + TGT)} FROM neg")

ORACLE["filter_targets"] = with_player() + (
    "SELECT player_id, Target1 IS NOT NULL AS has_target1, "
    "CASE WHEN Target2 > 100 THEN 'high' ELSE 'normal' END AS t2_band FROM player "
    "WHERE NOT (Target1 IS NULL AND Target2 IS NULL AND Target3 IS NULL)")


def _ones(cs):
    return "(" + " + ".join(f"CAST(coalesce({qi(c)} = -1, false) AS INTEGER)" for c in cs) + ")"


ORACLE["skip_rates"] = with_player(C1, C2) + (
    f"SELECT round(sum({_ones(P)}) / {len(P)}.0, 6) AS taxa_pulos_P, round(sum({_ones(T)}) / {len(T)}.0, 6) AS taxa_pulos_T, "
    f"round((sum({_ones(P)}) + sum({_ones(T)})) / {len(P) + len(T)}.0, 6) AS taxa_pulos_geral FROM c2")

ORACLE["skip_rates_row"] = with_player(C1, C2) + (
    f"SELECT player_id, round({_ones(P)} / {len(P)}.0, 6) AS taxa_pulos_P, round({_ones(T)} / {len(T)}.0, 6) AS taxa_pulos_T, "
    f"round(({_ones(P)} + {_ones(T)}) / {len(P) + len(T)}.0, 6) AS taxa_pulos_geral FROM c2")

ORACLE["median_values"] = with_player(C1, C2, NULLED) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(median({qi(c)}), 6) AS median FROM nulled" for c in FAMC)

CATS = ["Cor0202", "Cor0204"] + P
ORACLE["mode_impute"] = with_player(C1, C2, NULLED, *[
    f"{qi('mode_' + c)} AS (SELECT {qi(c)} AS v FROM nulled WHERE {qi(c)} IS NOT NULL GROUP BY {qi(c)} "
    f"ORDER BY count(*) DESC, {qi(c)} ASC LIMIT 1)" for c in CATS]) + (
    "SELECT player_id, " + ", ".join(
        (f"coalesce({qi(c)}, (SELECT v FROM {qi('mode_' + c)})) AS {qi(c)}" if c.startswith("Cor") else
         f"round(coalesce({qi(c)}, (SELECT v FROM {qi('mode_' + c)})), 6) AS {qi(c)}") for c in CATS)
    + " FROM nulled")

OUT_COLS = ["F0103"] + T + FX
QRT = ("qrt AS (SELECT " + ", ".join(
    f"quantile_cont({qi(c)}, 0.25) AS {qi('q1_' + c)}, quantile_cont({qi(c)}, 0.75) AS {qi('q3_' + c)}, "
    f"median({qi(c)}) AS {qi('m_' + c)}" for c in OUT_COLS) + " FROM clean)")


def _lo(c):
    return f"({qi('q1_' + c)} - 1.5 * ({qi('q3_' + c)} - {qi('q1_' + c)}))"


def _hi(c):
    return f"({qi('q3_' + c)} + 1.5 * ({qi('q3_' + c)} - {qi('q1_' + c)}))"


ORACLE["iqr_outliers"] = with_player(C1, C2, NULLED, MED, CLEAN, QRT) + (
    "SELECT player_id, " + ", ".join(
        f"round(CASE WHEN {qi(c)} < {_lo(c)} OR {qi(c)} > {_hi(c)} THEN {qi('m_' + c)} ELSE {qi(c)} END, 6) AS {qi(c)}"
        for c in OUT_COLS) + " FROM clean, qrt")

ORACLE["outlier_counts"] = with_player(C1, C2, NULLED, MED, CLEAN, QRT) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(any_value({_lo(c)}), 6) AS lower, round(any_value({_hi(c)}), 6) AS upper, "
    f"count_if({qi(c)} < {_lo(c)} OR {qi(c)} > {_hi(c)}) AS outliers FROM clean, qrt" for c in OUT_COLS)

ORACLE["one_hot"] = with_player() + "\nUNION ALL\n".join(
    f"SELECT player_id, '{c}_' || v AS dummy, CAST(coalesce({c} = v, false) AS INTEGER) AS flag "
    f"FROM player, (SELECT DISTINCT {c} AS v FROM player WHERE {c} IS NOT NULL) lv" for c in ("Cor0202", "Cor0204"))

ORACLE["one_hot_sparse"] = with_player() + "\nUNION ALL\n".join(
    f"SELECT player_id, '{c}_' || CAST({c} AS VARCHAR) AS dummy FROM player WHERE {c} IS NOT NULL"
    for c in ["Cor0202", "Cor0204"] + P)

ORACLE["row_id"] = with_player() + (
    "SELECT count(*) AS rows, count(DISTINCT player_id) AS ids, min(CAST(player_id AS VARCHAR)) AS least, 'given' AS kind "
    "FROM player UNION ALL SELECT count(*), count(*), '0', 'running' FROM player")

ORACLE["row_stats"] = with_player(C1, C2, NULLED) + (
    f"SELECT player_id, {r6(S.row_mean(P))} AS P_mean, {r6(S.row_std(P))} AS P_std, {r6(S.row_min(P))} AS P_min, "
    f"{r6(S.row_max(P))} AS P_max, {r6(S.row_max(P) + ' - ' + S.row_min(P))} AS P_range, "
    f"{r6(S.row_sum(T))} AS T_total, {r6(S.row_std(T))} AS T_std FROM nulled")

ORACLE["guarded_group_means"] = with_player(C1, C2, NULLED) + (
    f"SELECT player_id, {r6(S.row_mean(['F1101', 'F1102', 'F1103']))} AS F11_mean, {r6(S.row_mean(LATE))} AS P_late, "
    f"{r6(S.row_mean(EARLY))} AS P_early, CAST(0.0 AS DOUBLE) AS P_late_without_p15, "
    f"{r6(S.row_mean(['P09', 'P12', 'P13']))} AS P_late_prefix_without_p15 FROM nulled")

ORACLE["features_target1"] = eng_prefix() + "SELECT player_id, " + ", ".join(
    f"round({qi(k)}, 6) AS {qi(k)}" for k in T1F) + " FROM eng"

ORACLE["features_target2"] = with_player(C1, C2, NULLED, MED, CLEAN) + (
    f"SELECT player_id, round(QtdHorasDormi, 6) AS sono_total, round(Acordar, 6) AS acordar, "
    f"{r6(S.row_mean(['F0701', 'F0702']))} AS F_sono_mean, {r6(S.row_mean(['F1101', 'F1102', 'F1103']))} AS F_final_mean, "
    f"{r6(S.row_mean(P))} AS P_mean FROM clean")

_S7 = ["F0701", "F0702"]
_S11 = ["F1101", "F1102", "F1103"]
ORACLE["features_target3"] = with_player(C1, C2, NULLED, MED, CLEAN,
                                         "c3 AS (SELECT clean.*, QtdHorasDormi + 1 AS QtdHorasSono FROM clean)") + (
    f"SELECT player_id, {r6(S.row_mean(P))} AS P_mean, {r6(S.row_std(P))} AS P_std, {r6(S.row_mean(LATE))} AS P_late, "
    f"{r6(S.row_mean(EARLY))} AS P_early, {r6(S.row_mean(T))} AS T_mean, {r6(S.row_std(T))} AS T_std, "
    f"{r6(S.row_mean(_S7))} AS F_sono_mean, {r6(S.row_std(_S7))} AS F_sono_std, {r6(S.row_max(_S7))} AS F_sono_max, "
    f"round(QtdHorasSono * Acordar, 6) AS sono_x_acordar, round(Acordar * Acordar, 6) AS acordar_squared, "
    f"{r6(S.row_mean(_S11))} AS F_final_mean, {r6('F1103 * ' + S.row_mean(P))} AS F1103_X_P_mean FROM c3")

ORACLE["features_cluster"] = with_player(C1, C2, NULLED, MED, CLEAN) + (
    f"SELECT player_id, {r6(S.row_mean(P))} AS P_mean, {r6(S.row_std(P))} AS P_std, {r6(S.row_max(P))} AS P_max, "
    f"{r6(S.row_mean(T))} AS T_mean, {r6(S.row_sum(T))} AS T_total, {r6(S.row_mean(_S7))} AS F_sono_mean, "
    f"{r6(S.row_mean(_S11))} AS F_final_mean FROM clean")

VAR = "var AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, var_pop(coalesce(CAST({qi(c)} AS DOUBLE), 0.0)) AS variance, "
    f"abs({S.guarded_corr(qi(c), 'Target1')}) AS abs_corr, abs({S.guarded_corr(qi(c), 'Target3')}) AS abs_corr3 FROM eng"
    for c in POOL) + ")"
RANK1 = ("rk AS (SELECT feature, abs_corr, row_number() OVER (ORDER BY round(abs_corr * 1e12) / 1e12 DESC, feature ASC) AS \"rank\" "
         "FROM var WHERE variance > 0.01 AND abs_corr IS NOT NULL)")

ORACLE["variance_filter"] = eng_prefix(VAR) + (
    "SELECT feature, round(variance, 6) AS variance, variance > 0.01 AS kept FROM var")

ORACLE["corr_rank_target1"] = eng_prefix(VAR, RANK1) + (
    "SELECT feature, round(abs_corr, 6) AS abs_corr, \"rank\" FROM rk WHERE \"rank\" <= 30")

ORACLE["corr_rank_target2"] = eng_prefix("v2 AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, abs({S.guarded_corr(qi(c), 'Target2')}) AS abs_corr FROM eng" for c in POOL) + ")") + (
    "SELECT feature, round(abs_corr, 6) AS abs_corr, \"rank\" FROM (SELECT *, row_number() OVER "
    "(ORDER BY round(abs_corr * 1e12) / 1e12 DESC, feature ASC) AS \"rank\" FROM v2 WHERE abs_corr IS NOT NULL) WHERE \"rank\" <= 12")

ORACLE["corr_select_target3"] = eng_prefix(VAR) + (
    "SELECT feature, round(abs_corr3, 6) AS abs_corr, \"rank\" FROM (SELECT feature, abs_corr3, "
    "row_number() OVER (ORDER BY round(abs_corr3 * 1e12) / 1e12 DESC, feature ASC) AS \"rank\" FROM var WHERE abs_corr3 IS NOT NULL) "
    "WHERE abs_corr3 > 0.35 AND \"rank\" <= 15")

REPORT = "rep AS (" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS Feature, " + ", ".join(f"abs({S.guarded_corr(qi(c), t)}) AS Corr_{t}" for t in TGT)
    + " FROM eng" for c in POOL) + ")"
REPORT2 = ("rep2 AS (SELECT *, (Corr_Target1 + Corr_Target2 + Corr_Target3) / 3 AS Corr_Media FROM rep)")

ORACLE["corr_report"] = eng_prefix(REPORT, REPORT2) + (
    "SELECT Feature, round(Corr_Target1, 6) AS Corr_Target1, round(Corr_Target2, 6) AS Corr_Target2, "
    "round(Corr_Target3, 6) AS Corr_Target3, round(Corr_Media, 6) AS Corr_Media, "
    "coalesce(Corr_Media > 0.20, false) AS Mantida FROM rep2")

ORACLE["corr_top10"] = eng_prefix(REPORT, REPORT2) + (
    "SELECT Feature, round(Corr_Media, 6) AS Corr_Media, \"rank\" FROM (SELECT Feature, Corr_Media, "
    "row_number() OVER (ORDER BY round(Corr_Media * 1e12) / 1e12 DESC, Feature ASC) AS \"rank\" FROM rep2 WHERE Corr_Media IS NOT NULL) "
    "WHERE \"rank\" <= 10")

_MCOLS = ["P_mean", "T_mean", "F_mean_geral", "sono_total", "Target1", "Target3"]
ORACLE["corr_matrix"] = eng_prefix() + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS row_feature, '{b}' AS col_feature, round({S.guarded_corr(qi(a), qi(b))}, 6) AS corr FROM eng"
    for a in _MCOLS for b in _MCOLS)

# all pairs through a long table of centred values
_ACOLS = POOL + TGT
ORACLE["corr_matrix_all"] = eng_prefix(
    "ec AS (SELECT row_number() OVER () AS rid, " + ", ".join(f"CAST({qi(c)} AS DOUBLE) - avg({qi(c)}) OVER () AS {qi(c)}" for c in _ACOLS) + " FROM eng)",
    "el AS (UNPIVOT ec ON " + ", ".join(qi(c) for c in _ACOLS) + " INTO NAME f VALUE x)") + (
    "SELECT a.f AS row_feature, b.f AS col_feature, CASE WHEN stddev_pop(a.x) > 1e-9 AND stddev_pop(b.x) > 1e-9 "
    "THEN round(covar_pop(a.x, b.x) / (stddev_pop(a.x) * stddev_pop(b.x)), 6) END AS corr FROM el a JOIN el b USING (rid) GROUP BY a.f, b.f")

_DCOLS = ["Target1", "Target2", "Target3", "P_mean", "T_mean", "F0103"]
ORACLE["describe"] = eng_prefix() + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count({qi(c)}) AS count, round(avg({qi(c)}), 6) AS mean, "
    f"round(stddev_samp({qi(c)}), 6) AS std, round(min({qi(c)}), 6) AS min, "
    f"round(quantile_cont({qi(c)}, 0.25), 6) AS q25, round(quantile_cont({qi(c)}, 0.5), 6) AS q50, "
    f"round(quantile_cont({qi(c)}, 0.75), 6) AS q75, round(max({qi(c)}), 6) AS max FROM eng" for c in _DCOLS)

ENGD = ("engd AS (SELECT player_id, " + ", ".join(f"CAST({qi(c)} AS DOUBLE) AS {qi(c)}" for c in POOL)
        + " FROM eng)")
LNG = ("lng AS (SELECT * FROM engd UNPIVOT INCLUDE NULLS (value FOR feature IN (" + cols(POOL) + ")))")
ORACLE["interactions_target1"] = eng_prefix(VAR, RANK1, ENGD, LNG) + (
    "SELECT la.player_id, a.feature || '_X_' || b.feature AS interaction, round(la.value * lb.value, 6) AS value "
    "FROM rk a JOIN rk b ON a.\"rank\" < b.\"rank\" AND a.\"rank\" <= 3 AND b.\"rank\" <= 3 "
    "JOIN lng la ON la.feature = a.feature JOIN lng lb ON lb.feature = b.feature AND lb.player_id = la.player_id")

_ZC = ["P_mean", "T_mean", "F_mean_geral", "sono_total", "F0103"]
_ZS = ("zs AS (SELECT " + ", ".join(
    f"avg({qi(c)}) AS {qi('a_' + c)}, coalesce(nullif(stddev_pop({qi(c)}), 0), 1.0) AS {qi('s_' + c)}" for c in _ZC)
    + " FROM eng)")
ORACLE["standard_scaled"] = eng_prefix(_ZS) + (
    "SELECT player_id, " + ", ".join(
        f"round(({qi(c)} - {qi('a_' + c)}) / {qi('s_' + c)}, 6) AS {qi(c)}" for c in _ZC)
    + ", CAST(Cor0202 = '1-URGENT' AS INTEGER) AS \"Cor0202_1-URGENT\" FROM eng, zs")

_RC = ["P_mean", "T_mean", "F_mean_geral", "sono_irregular", "F0103"]
ORACLE["robust_scaled"] = eng_prefix(
    "fz AS (SELECT player_id, " + ", ".join(f"coalesce({qi(c)}, 0.0) AS {qi(c)}" for c in _RC) + " FROM eng)",
    "rq AS (SELECT " + ", ".join(
        f"median({qi(c)}) AS {qi('m_' + c)}, coalesce(nullif(quantile_cont({qi(c)}, 0.75) - quantile_cont({qi(c)}, 0.25), 0), 1.0) AS {qi('i_' + c)}"
        for c in _RC) + " FROM fz)") + (
    "SELECT player_id, " + ", ".join(
        f"round(({qi(c)} - {qi('m_' + c)}) / {qi('i_' + c)}, 6) AS {qi(c)}" for c in _RC) + " FROM fz, rq")


def hbucket(id_expr, seed, mod=100):
    return f"(('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || ':{seed}'), 1, 8))::UBIGINT % {mod})"


def split_sql(id_expr, seed, pct):
    return f"CASE WHEN {hbucket(id_expr, seed)} < {pct} THEN 'test' ELSE 'train' END"


ORACLE["split_assign"] = with_player() + (
    "SELECT player_id, " + ", ".join(f"{split_sql('player_id', s, 25)} AS split_{s}" for s in (42, 123, 456))
    + f", {split_sql('player_id', 42, 20)} AS split80_42 FROM player WHERE Target1 IS NOT NULL")

ORACLE["kfold_assign"] = with_player() + (
    f"SELECT player_id, CAST({hbucket('player_id', 42, 1 << 30)} % 5 AS INTEGER) AS fold5, "
    f"CAST({hbucket('player_id', 42, 1 << 30)} % 3 AS INTEGER) AS fold3 FROM player")

ORACLE["align_features"] = eng_prefix() + (
    "SELECT player_id, round(T_mean, 6) AS T_mean, round(P_mean, 6) AS P_mean, CAST(0.0 AS DOUBLE) AS not_in_upload, "
    "round(sono_x_acordar, 6) AS sono_x_acordar, round(P_mean * T_mean, 6) AS P_mean_X_T_mean FROM eng")


def _member(t, s):
    b, coefs = FIXED_LINEAR[t]
    return f"({b * s!r}" + "".join(f" + {w * s!r} * {qi(c)}" for c, w in coefs.items()) + ")"


def pred_sql(t):
    ms = [_member(t, s) for s in FIXED_ENSEMBLE_SCALE]
    return "((" + " + ".join(ms) + f") / {len(ms)})"


SCORED = ("sc AS (SELECT eng.*, " + ", ".join(f"{pred_sql(t)} AS {p}" for t, p in PRED_NAMES.items())
          + " FROM eng)")
PREDS = list(PRED_NAMES.values())

ORACLE["ensemble_predictions"] = eng_prefix(SCORED) + f"SELECT player_id, {rounded(PREDS)} FROM sc"

ORACLE["prediction_output"] = eng_prefix(SCORED) + (
    "SELECT CAST(player_id AS VARCHAR) AS \"Código de Acesso\", " + ", ".join(
        f"round_even({p}, 2) AS \"Previsão T{i + 1}\"" for i, p in enumerate(PREDS)) + " FROM sc")

SPLIT = f"sp AS (SELECT sc.*, {split_sql('player_id', 42, 25)} AS split FROM sc)"


def _metrics(t, p, where):
    both = f"{t} IS NOT NULL AND {p} IS NOT NULL"
    return (f"SELECT '{t}' AS target, 1 - sum(({t} - {p}) * ({t} - {p})) / (var_pop({t}) * count(*)) AS r2, "
            f"avg(abs({t} - {p})) AS mae, sqrt(avg(({t} - {p}) * ({t} - {p}))) AS rmse, "
            f"avg(abs({t} - {p}) / greatest(abs({t}), 1e-10)) * 100 AS mape, count(*) AS n "
            f"FROM sp WHERE {both} AND {where}")


ORACLE["metrics_by_split"] = eng_prefix(
    SCORED, SPLIT,
    "tr AS (" + " UNION ALL ".join(_metrics(t, p, "split = 'train'") for t, p in PRED_NAMES.items()) + ")",
    "te AS (" + " UNION ALL ".join(_metrics(t, p, "split = 'test'") for t, p in PRED_NAMES.items()) + ")") + (
    "SELECT tr.target, round(tr.r2, 6) AS r2_train, round(te.r2, 6) AS r2_test, round(te.mae, 6) AS mae_test, "
    "round(te.rmse, 6) AS rmse_test, round(te.mape, 6) AS mape_test, te.n AS n_test, "
    "round(CASE WHEN tr.r2 > 0 THEN abs(tr.r2 - te.r2) / tr.r2 * 100 ELSE 0.0 END, 6) AS overfitting_pct "
    "FROM tr JOIN te ON tr.target = te.target")

ORACLE["metrics_report"] = eng_prefix(
    SCORED, "sp AS (SELECT * FROM sc)",
    "m AS (" + " UNION ALL ".join(_metrics(t, p, "true") for t, p in PRED_NAMES.items()) + ")",
    "names AS (SELECT * FROM (VALUES ('Target1', 'R1 (Performance)', 4.0), ('Target2', 'R2 (Variável)', 4.0), "
    "('Target3', 'R3 (Formulários)', 4.0), ('Target4', 'não encontrado', NULL)) v(target, name, k))") + (
    "SELECT name, names.target, round(r2, 6) AS r2_test, round(mae, 6) AS mae_test, round(rmse, 6) AS rmse_test, "
    "CAST(k AS DOUBLE) AS n_features FROM names LEFT JOIN m ON names.target = m.target")

_SBAR = sum(FIXED_ENSEMBLE_SCALE) / len(FIXED_ENSEMBLE_SCALE)
_CF = sorted({c for _, coefs in FIXED_LINEAR.values() for c in coefs})
CONTRIB = ("ct AS (" + "\nUNION ALL\n".join(
    f"SELECT player_id, '{t}' AS target, '{c}' AS feature, {w * _SBAR!r} * ({qi(c)} - {qi('mu_' + c)}) AS value "
    f"FROM eng, mu" for t, (_, coefs) in FIXED_LINEAR.items() for c, w in coefs.items()) + ")")
MU = "mu AS (SELECT " + ", ".join(f"avg({qi(c)}) AS {qi('mu_' + c)}" for c in _CF) + " FROM eng)"

ORACLE["linear_contributions"] = eng_prefix(MU, CONTRIB) + (
    "SELECT player_id, target, feature, round(value, 6) AS value FROM ct")

WIDE = {c: (i % 7 + 1) / 7 * (-1) ** i for i, c in enumerate(sorted(POOL))}
ORACLE["top_contributions"] = eng_prefix(
    "wm AS (SELECT " + ", ".join(f"avg({qi(c)}) AS {qi('mu_' + c)}" for c in WIDE) + " FROM eng)",
    "wc AS (" + "\nUNION ALL\n".join(
        f"SELECT player_id, 'Target1' AS target, '{c}' AS feature, {w!r} * ({qi(c)} - {qi('mu_' + c)}) AS value FROM eng, wm"
        for c, w in WIDE.items()) + ")") + (
    "SELECT player_id, target, feature, round(value, 6) AS value, \"rank\" FROM (SELECT *, row_number() OVER "
    "(PARTITION BY player_id, target ORDER BY abs(value) DESC, feature ASC) AS \"rank\" FROM wc WHERE value IS NOT NULL) "
    "WHERE \"rank\" <= 15")

ORACLE["lookup_history"] = eng_prefix(SCORED, MU, CONTRIB) + (
    "SELECT CAST(sc.player_id AS VARCHAR) AS jogador_id, t.target, round(CASE t.target "
    + " ".join(f"WHEN '{t}' THEN {p}" for t, p in PRED_NAMES.items()) + " END, 6) AS prediction, feature, "
    "round(value, 6) AS value FROM sc JOIN ct t ON t.player_id = sc.player_id WHERE sc.player_id = 7")

ORACLE["history_replay"] = eng_prefix(SCORED) + "\nUNION ALL\n".join(
    f"SELECT '{run}' AS run_id, {batch}::INT AS batch_id, count(*) AS rows, count(*) AS ids, "
    f"round(avg(round_even(pred_t2, 2)), 6) AS avg_t2 FROM sc WHERE player_id % 2 {op} 0"
    for run, batch, op in (("a", 0, "="), ("a", 1, "<>"), ("b", 0, "<>")))

ORACLE["lookup_player"] = eng_prefix(SCORED) + (
    f"SELECT player_id, {rounded(PREDS)} FROM sc WHERE player_id = (SELECT min(player_id) FROM sc)")

ORACLE["kpis"] = eng_prefix(SCORED) + (
    "SELECT count(*) AS players, " + ", ".join(f"round(avg({p}), 6) AS avg_{p}" for p in PREDS) + " FROM sc")

ORACLE["prediction_histogram"] = eng_prefix(SCORED, "mm AS (SELECT " + ", ".join(
    f"min({p}) AS lo_{p}, (max({p}) - min({p})) / 20 AS w_{p}" for p in PREDS) + " FROM sc)") + "\nUNION ALL\n".join(
    f"SELECT '{p}' AS \"column\", bin, round(any_value(lo_{p}) + bin * any_value(w_{p}), 6) AS bin_lo, "
    f"round(any_value(lo_{p}) + (bin + 1) * any_value(w_{p}), 6) AS bin_hi, count(*) AS count FROM "
    f"(SELECT CAST(least(floor(({p} - lo_{p}) / w_{p}), 19) AS INTEGER) AS bin, lo_{p}, w_{p} FROM sc, mm "
    f"WHERE {p} IS NOT NULL) GROUP BY bin" for p in PREDS)

_BOXQ = ("bq AS (SELECT " + ", ".join(
    f"quantile_cont({p}, 0.25) AS q1_{p}, median({p}) AS m_{p}, quantile_cont({p}, 0.75) AS q3_{p}" for p in PREDS)
    + " FROM sc)")


def _box(p):
    lo = f"(q1_{p} - 1.5 * (q3_{p} - q1_{p}))"
    hi = f"(q3_{p} + 1.5 * (q3_{p} - q1_{p}))"
    return (f"SELECT '{p}' AS \"column\", round(any_value(q1_{p}), 6) AS q1, round(any_value(m_{p}), 6) AS median, "
            f"round(any_value(q3_{p}), 6) AS q3, round(any_value({lo}), 6) AS lower_fence, "
            f"round(any_value({hi}), 6) AS upper_fence, "
            f"round(min(CASE WHEN {p} >= {lo} AND {p} <= {hi} THEN {p} END), 6) AS whisker_low, "
            f"round(max(CASE WHEN {p} >= {lo} AND {p} <= {hi} THEN {p} END), 6) AS whisker_high, "
            f"count_if({p} < {lo} OR {p} > {hi}) AS n_outliers FROM sc, bq")


ORACLE["prediction_boxplot"] = eng_prefix(SCORED, _BOXQ) + "\nUNION ALL\n".join(_box(p) for p in PREDS)

_MMC = ["QtdHorasDormi", "Acordar", "F0103", "Target1", "Target2", "Target3"]
ORACLE["column_min_max"] = eng_prefix() + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", round(min({qi(c)}), 6) AS min, round(max({qi(c)}), 6) AS max FROM eng" for c in _MMC)

ORACLE["melt_predictions"] = eng_prefix(SCORED) + "\nUNION ALL\n".join(
    f"SELECT player_id, '{p}' AS target, round({p}, 6) AS prediction FROM sc" for p in PREDS)

ORACLE["page_predictions"] = eng_prefix(SCORED) + (
    f"SELECT player_id, {rounded(PREDS)} FROM sc WHERE pred_t2 > 100 ORDER BY pred_t1 DESC, player_id ASC "
    "LIMIT 25 OFFSET 10")

ORACLE["ols_one_feature"] = eng_prefix(SCORED, SPLIT) + " UNION ALL ".join(
    f"SELECT '{t}' AS target, round(regr_slope({t}, P_mean), 6) AS slope, round(regr_intercept({t}, P_mean), 6) "
    f"AS intercept FROM sp WHERE split = 'train' AND {t} IS NOT NULL" for t in TGT)


def _loo(t, case, where):
    return (f"SELECT '{case}' AS \"case\", '{t}' AS target, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2_loo, "
            f"round(avg(abs(e)), 6) AS mae_loo, round(sqrt(avg(e * e)), 6) AS rmse_loo, count(*) AS n FROM ("
            f"SELECT y, (y - (a + b * x)) / (1 - (1.0 / n + (x - xbar) * (x - xbar) / sxx)) AS e FROM "
            f"(SELECT {t} AS y, P_mean AS x FROM eng WHERE {t} IS NOT NULL AND {where}) d, "
            f"(SELECT count(*) AS n, avg(P_mean) AS xbar, var_pop(P_mean) * count(*) AS sxx, "
            f"regr_intercept({t}, P_mean) AS a, regr_slope({t}, P_mean) AS b FROM eng WHERE {t} IS NOT NULL AND {where}) s)")


ORACLE["loo_linear"] = eng_prefix() + " UNION ALL ".join(
    _loo(t, case, where) for case, where in (("all", "true"), ("missing", "Acordar <> 0")) for t in TGT)


def _ols2(t, x1, x2, name):
    """Least squares on two features by the normal equations (the scaling of
    the features does not change the predictions)."""
    m = (f"SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, "
         f"covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM (SELECT {x1} AS x1, {x2} AS x2, {t} AS y FROM eng WHERE {t} IS NOT NULL)")
    return (f"{name} AS (SELECT player_id, my + (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) * ({x1} - m1) "
            f"+ (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) * ({x2} - m2) AS pred FROM eng, ({m}) m)")


ORACLE["saved_plan_scoring"] = eng_prefix(
    _ols2("Target1", "P_mean", "P_mean * T_mean", "o1"), _ols2("Target3", "T_mean", "F1103 * P_mean", "o3")) + (
    "SELECT CAST(o1.player_id AS VARCHAR) AS \"Código de Acesso\", round_even(o1.pred, 2) AS \"Previsão T1\", "
    "CAST(NULL AS DOUBLE) AS \"Previsão T2\", round_even(o3.pred, 2) AS \"Previsão T3\" FROM o1 JOIN o3 ON o1.player_id = o3.player_id")

ORACLE["uploads_readback"] = with_player() + (
    f"SELECT player_id, Cor0202, Cor0204, F0103, {rounded(['QtdHorasDormi', 'Acordar'] + PIV + TGT)} FROM player")

_CLF = ["P_mean", "P_std", "T_mean", "F_sono_mean", "F_final_mean"]
_CLUSTER_RAW = {"P_mean": S.row_mean(P), "P_std": S.row_std(P), "T_mean": S.row_mean(T),
                "F_sono_mean": S.row_mean(_S7), "F_final_mean": S.row_mean(_S11)}
CL = ("cl AS (SELECT player_id, " + ", ".join(f"{v} AS {qi(k)}" for k, v in _CLUSTER_RAW.items()) + " FROM clean)")
CLS = ("cls AS (SELECT " + ", ".join(
    f"avg({qi(c)}) AS {qi('a_' + c)}, coalesce(nullif(stddev_pop({qi(c)}), 0), 1.0) AS {qi('s_' + c)}" for c in _CLF)
    + " FROM cl)")
CLZ = ("clz AS (SELECT player_id, P_mean AS raw_p_mean, " + ", ".join(
    f"({qi(c)} - {qi('a_' + c)}) / {qi('s_' + c)} AS {qi(c)}" for c in _CLF) + " FROM cl, cls)")


def _dist(k):
    return "(" + " + ".join(f"pow({qi(c)} - {v!r}, 2)" for c, v in zip(_CLF, FIXED_CENTROIDS[k])) + ")"


CLA = ("cla AS (SELECT clz.*, CASE WHEN " + _dist(0) + " <= " + _dist(1) + " THEN 0 ELSE 1 END AS cluster, "
       + ", ".join("(" + " + ".join(f"{w!r} * {qi(c)}" for c, w in zip(_CLF, comp)) + f") AS pc{j + 1}"
                   for j, comp in enumerate(FIXED_LOADINGS)) + " FROM clz)")


def cl_prefix(*extra):
    return with_player(C1, C2, NULLED, MED, CLEAN, CL, CLS, CLZ, CLA, *extra)


ORACLE["cluster_assign"] = cl_prefix() + "SELECT player_id, cluster FROM cla"
ORACLE["pca_project"] = cl_prefix() + "SELECT player_id, round(pc1, 6) AS pc1, round(pc2, 6) AS pc2 FROM cla"

NAMES = ("nm AS (SELECT cluster, mean_score, CASE WHEN row_number() OVER (ORDER BY mean_score DESC, cluster DESC) = 1 "
         "THEN 'Perfil A (Alto Desempenho)' ELSE 'Perfil B (Desempenho Moderado)' END AS name FROM "
         "(SELECT cluster, avg(raw_p_mean) AS mean_score FROM cla GROUP BY cluster))")
ORACLE["cluster_names"] = cl_prefix(NAMES) + "SELECT cluster, round(mean_score, 6) AS mean_score, name FROM nm"

ORACLE["cluster_report"] = with_player(C1, C2, NULLED, MED, CLEAN, CL, CLS, CLZ, CLA, NAMES, ENG, SCORED) + (
    "SELECT a.cluster, a.count, round(coalesce(a.P_mean, 0.0), 6) AS P_mean, "
    + ", ".join(f"round(coalesce(a.mean_{p}, 0.0), 6) AS mean_{p}" for p in PREDS)
    + ", round(a.count * 100.0 / sum(a.count) OVER (), 6) AS percentage, "
    "round(a.count / sum(a.count) OVER (), 6) AS share, nm.name FROM (SELECT cla.cluster, count(*) AS count, "
    "avg(raw_p_mean) AS P_mean, " + ", ".join(f"avg(sc.{p}) AS mean_{p}" for p in PREDS)
    + " FROM cla JOIN sc ON cla.player_id = sc.player_id GROUP BY cla.cluster) a LEFT JOIN nm ON a.cluster = nm.cluster")

ORACLE["history_by_upload"] = (
    "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS timestamp, count(event_id) AS num_jogadores "
    "FROM events WHERE user_id = 8 GROUP BY date_trunc('day', ts)")

ORACLE["stream_scoring"] = eng_prefix(SCORED) + (
    "SELECT CAST(1 AS INTEGER) AS user_id, CAST(player_id AS VARCHAR) AS jogador_id, " + ", ".join(
        f"round_even({p}, 2) AS {p}" for p in PREDS) + " FROM sc")


# Z3 uniform stage: quantiles on an 11-point grid, then NumPy-style interp in
# both directions — j = last index with q ≤ x, k = first index with q ≥ x
# (1-based lists), u = ½(up + down), clipped to 0/1 at the ends.
_QU = ["P_mean", "T_mean", "F_mean_geral"]
_QN = 11
_QGRID = "[" + ", ".join(repr(i / (_QN - 1)) for i in range(_QN)) + "]"


def _fp(i):
    return f"(CAST(({i}) - 1 AS DOUBLE) / {_QN - 1})"


def _uniform_sql(c):
    x, L = f"CAST({qi(c)} AS DOUBLE)", qi("q_" + c)
    j, k = qi("j_" + c), qi("k_" + c)
    up = (f"CASE WHEN {x} = {L}[{j}] THEN {_fp(j)} ELSE "
          f"({_fp(f'{j} + 1')} - {_fp(j)}) / ({L}[{j} + 1] - {L}[{j}]) * ({x} - {L}[{j}]) + {_fp(j)} END")
    down = (f"CASE WHEN {x} = {L}[{k}] THEN {_fp(k)} ELSE "
            f"{_fp(k)} - ({_fp(k)} - {_fp(f'{k} - 1')}) / ({L}[{k}] - {L}[{k} - 1]) * ({L}[{k}] - {x}) END")
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {L}[1] THEN 0.0 WHEN {x} >= {L}[{_QN}] THEN 1.0 "
            f"ELSE 0.5 * (({up}) + ({down})) END")


ORACLE["quantile_uniform"] = eng_prefix(
    "qz AS (SELECT " + ", ".join(f"quantile_cont(CAST({qi(c)} AS DOUBLE), {_QGRID}) AS {qi('q_' + c)}" for c in _QU)
    + " FROM eng)",
    "jk AS (SELECT player_id, " + ", ".join(qi(c) for c in _QU) + ", " + ", ".join(qi("q_" + c) for c in _QU) + ", "
    + ", ".join(
        "(" + " + ".join(f"CASE WHEN {qi('q_' + c)}[{i}] <= CAST({qi(c)} AS DOUBLE) THEN 1 ELSE 0 END"
                         for i in range(1, _QN + 1)) + f") AS {qi('j_' + c)}, "
        + f"{_QN + 1} - (" + " + ".join(f"CASE WHEN {qi('q_' + c)}[{i}] >= CAST({qi(c)} AS DOUBLE) THEN 1 ELSE 0 END"
                                         for i in range(1, _QN + 1)) + f") AS {qi('k_' + c)}"
        for c in _QU) + " FROM eng, qz)") + (
    "SELECT player_id, " + ", ".join(f"round({_uniform_sql(c)}, 6) AS {qi(c)}" for c in _QU) + " FROM jk")


def _ppf(u):
    """Inverse normal CDF, rational approximation in three pieces."""
    from ..operators.scale import _A, _B, _BOUNDS, _C, _D, _P_LOW
    poly = lambda cs, x: "(" * (len(cs) - 1) + f"({cs[0]!r})" + "".join(f" * {x} + ({c!r}))" for c in cs[1:])
    v = f"greatest({_BOUNDS!r}, least({1 - _BOUNDS!r}, {u}))"
    tail = lambda p: f"({poly(_C, f'sqrt(-2 * ln({p}))')} / {poly(_D + (1.0,), f'sqrt(-2 * ln({p}))')})"
    r = f"(({v} - 0.5) * ({v} - 0.5))"
    return (f"CASE WHEN {v} < {_P_LOW!r} THEN {tail(v)} WHEN {v} > {1 - _P_LOW!r} THEN -{tail(f'(1 - {v})')} "
            f"ELSE {poly(_A, r)} * ({v} - 0.5) / {poly(_B + (1.0,), r)} END")


ORACLE["quantile_normal_small"] = ORACLE["quantile_uniform"].rpartition("SELECT player_id, ")[0] + (
    "SELECT player_id, " + ", ".join(f"round({_ppf(qi(c))}, 6) AS {qi(c)}" for c in _QU)
    + " FROM (SELECT player_id, " + ", ".join(f"{_uniform_sql(c)} AS {qi(c)}" for c in _QU) + " FROM jk)")

ORACLE["split_exact"] = with_player() + "SELECT player_id, " + ", ".join(
    f"CASE WHEN row_number() OVER (ORDER BY ('0x' || substr(md5(player_id::VARCHAR || ':{s}'), 1, 13))::BIGINT, player_id::VARCHAR) "
    f"<= ceil(count(*) OVER () * {share}) THEN 'test' ELSE 'train' END AS split_{s}" for s, share in ((42, 0.2), (123, 0.25), (456, 0.25))) + " FROM player"

# the quantile scaler of target 2 is fitted on the rows that have the target
ORACLE["three_target_scoring"] = ORACLE["quantile_uniform"].rpartition("SELECT player_id, ")[0].rstrip().replace(
    f"AS {qi('q_' + _QU[-1])} FROM eng)", f"AS {qi('q_' + _QU[-1])} FROM eng WHERE Target2 IS NOT NULL)") + (
    ", " + _ols2("Target1", "P_mean", "P_mean * T_mean", "o1") + ", " + _ols2("Target3", "T_mean", "F1103 * P_mean", "o3")
    + f", nq AS (SELECT player_id, {_ppf('u')} AS z FROM (SELECT player_id, {_uniform_sql('P_mean')} AS u FROM jk)), "
    "o2 AS (SELECT nq.player_id, a + b * z AS pred FROM nq, (SELECT regr_intercept(Target2, z) AS a, regr_slope(Target2, z) AS b "
    "FROM nq JOIN eng USING (player_id) WHERE Target2 IS NOT NULL)) "
    "SELECT CAST(o1.player_id AS VARCHAR) AS \"Código de Acesso\", round_even(o1.pred, 2) AS \"Previsão T1\", "
    "round_even(o2.pred, 2) AS \"Previsão T2\", round_even(o3.pred, 2) AS \"Previsão T3\" "
    "FROM o1 JOIN o2 ON o1.player_id = o2.player_id JOIN o3 ON o1.player_id = o3.player_id")

ORACLE["export_outputs"] = with_player() + " UNION ALL ".join(
    f"SELECT '{n}' AS name, {k} AS rows FROM player" for n, k in (("clean", "count(*)"), ("scaled", "count(*)"))) + (
    f" UNION ALL SELECT * FROM (VALUES ('target_summary', 3), ('correlations', 4), ('imputer_params', {len(FAMC)})) v(name, rows)")

ORACLE["kmeans_check"] = with_player() + (
    "SELECT count(*) AS rows, 10 AS starts, true AS centres_are_means, true AS none_is_lower, true AS inertia_is_right FROM player")
ORACLE["pca_check"] = "SELECT 1.0 AS length1, 1.0 AS length2, 0.0 AS angle, 0.0 AS covariance, 0.0 AS gap1, 0.0 AS gap2"
ORACLE["tree_contributions_check"] = with_player() + "SELECT count(*) AS players, 0.0 AS largest_gap FROM player"


def _linear_board(t, model, alpha):
    """Ridge (alpha on standardized slopes; 0 is least squares) on two features."""
    z = lambda c: f"(({c} - (SELECT avg({c}) FROM eng)) / (SELECT stddev_pop({c}) FROM eng))"
    return (f"SELECT '{t}' AS target, '{model}' AS model, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2, "
            f"round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e)), 6) AS mae, count(*) AS n FROM ("
            f"SELECT y, y - (my + w1 * (x1 - m1) + w2 * (x2 - m2)) AS e FROM "
            f"(SELECT {z('P_mean')} AS x1, {z('T_mean')} AS x2, {t} AS y FROM eng WHERE {t} IS NOT NULL AND {split_sql('player_id', 42, 20)} = 'test') d, "
            f"(SELECT m1, m2, my, ((s22 + {alpha}) * s1y - s12 * s2y) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS w1, "
            f"((s11 + {alpha}) * s2y - s12 * s1y) / ((s11 + {alpha}) * (s22 + {alpha}) - s12 * s12) AS w2 FROM "
            f"(SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) * count(*) AS s11, var_pop(x2) * count(*) AS s22, "
            f"covar_pop(x1, x2) * count(*) AS s12, covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y FROM "
            f"(SELECT {z('P_mean')} AS x1, {z('T_mean')} AS x2, {t} AS y FROM eng WHERE {t} IS NOT NULL AND {split_sql('player_id', 42, 20)} = 'train'))))")


ORACLE["linear_leaderboard"] = eng_prefix() + " UNION ALL ".join(
    _linear_board(t, m, a) for t in TGT for m, a in (("linear", 0), ("ridge", 1)))

# M5: one symmetric tree of depth 2 (penalty 3, rate 0.1) on three features, 8 quantile borders between 4-decimal values
_TREE = ["P_mean", "T_mean", "sono_total"]
ORACLE["booster_one_tree"] = eng_prefix(
    "fx AS (SELECT row_number() OVER () AS rid, " + ", ".join(f"round({c} * 1e4) / 1e4 AS x{i}" for i, c in enumerate(_TREE)) + ", Target1 AS y FROM eng)",
    "cut AS (SELECT DISTINCT f, round(q * 1e4) / 1e4 + 0.00005 AS c FROM (" + " UNION ALL ".join(
        f"SELECT {i} AS f, unnest(quantile_cont(x{i}, [{', '.join(f'{k}.0::DOUBLE / 9' for k in range(1, 9))}])) AS q FROM fx" for i in range(3)) + "))",
    "gr AS (SELECT *, (SELECT avg(y) FROM fx) - y AS g FROM fx WHERE y IS NOT NULL)",
    "lg AS (SELECT rid, g, f, x FROM (" + " UNION ALL ".join(f"SELECT rid, g, {i} AS f, x{i} AS x FROM gr" for i in range(3)) + "))",
    "one AS (SELECT f, c FROM (SELECT f, c, sum(CASE WHEN x <= c THEN g ELSE 0 END) AS gl, count(*) FILTER (x <= c) AS hl, sum(g) AS gt, count(*) AS ht "
    "FROM lg JOIN cut USING (f) GROUP BY f, c) ORDER BY gl * gl / (hl + 3) + (gt - gl) * (gt - gl) / (ht - hl + 3) DESC, f, c LIMIT 1)",
    "sd AS (SELECT lg.rid, CASE WHEN x > c THEN 1 ELSE 0 END AS s FROM lg JOIN one USING (f))",
    "two AS (SELECT f, c FROM (SELECT f, c, s, sum(CASE WHEN x <= c THEN g ELSE 0 END) AS gl, count(*) FILTER (x <= c) AS hl, sum(g) AS gt, count(*) AS ht "
    "FROM lg JOIN sd USING (rid) JOIN cut USING (f) GROUP BY f, c, s) GROUP BY f, c "
    "ORDER BY sum(gl * gl / (hl + 3) + (gt - gl) * (gt - gl) / (ht - hl + 3) - gt * gt / (ht + 3)) DESC, f, c LIMIT 1)",
    "lf AS (SELECT 2 * s + CASE WHEN x > c THEN 1 ELSE 0 END AS leaf, g FROM lg JOIN two USING (f) JOIN sd USING (rid))") + (
    f"SELECT leaf::INT AS leaf, {[*_TREE]!r}[any_value(one.f) + 1] AS feature1, round(any_value(one.c), 6) AS border1, "
    f"{[*_TREE]!r}[any_value(two.f) + 1] AS feature2, round(any_value(two.c), 6) AS border2, "
    "round(-0.1 * sum(g) / (count(*) + 3), 6) AS value, count(*) AS rows FROM lf, one, two GROUP BY leaf")

# S4/S8 read-back of the exported scaled table (Z1 on four features, targets kept)
_XC = ["P_mean", "T_mean", "F_mean_geral", "sono_total"]
ORACLE["export_readback"] = eng_prefix(
    "xs AS (SELECT " + ", ".join(
        f"avg({qi(c)}) AS {qi('a_' + c)}, coalesce(nullif(stddev_pop({qi(c)}), 0), 1.0) AS {qi('s_' + c)}" for c in _XC)
    + " FROM eng)") + (
    "SELECT player_id, " + ", ".join(f"round(({qi(c)} - {qi('a_' + c)}) / {qi('s_' + c)}, 6) AS {qi(c)}" for c in _XC)
    + ", " + ", ".join(f"round({t}, 6) AS {t}" for t in ("Target1", "Target2", "Target3")) + " FROM eng, xs")
