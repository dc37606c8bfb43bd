"""Engineered feature sets (E1–E10) as one or two projections over a cleaned table.

Each builder only adds columns whose inputs exist (the schema decides, as in
the original scripts). Statistics a builder needs (the sleep median of E1) are
passed in as fitted numbers so that scoring can reuse training values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import families as FAM
from .rowstats import with_row_stats
from .sqltext import q


def _c(name) -> Column:
    return F.col("`" + name + "`")


def sleep_set_a(df: DataFrame, sleep_median: float | None) -> DataFrame:
    """Total, × wake, squared, |x − median| (target-1 set)."""
    if not FAM.all_present(df.columns, ("QtdHorasDormi", "Acordar")):
        return df
    s, a = _c("QtdHorasDormi"), _c("Acordar")
    return df.withColumns({
        "sono_total": s, "sono_x_acordar": s * a, "sono_squared": s * s,
        "sono_irregular": F.abs(s - F.lit(sleep_median).cast("double")),
    })


def sleep_set_b(df: DataFrame) -> DataFrame:
    """Copies (target-2 set)."""
    if not FAM.all_present(df.columns, ("QtdHorasDormi", "Acordar")):
        return df
    return df.withColumns({"sono_total": _c("QtdHorasDormi"), "acordar": _c("Acordar")})


def performance_spec(cols, match: str = "exact", full: bool = True) -> dict:
    """P mean/std/min/max (+ range, late, early when ``full``).

    ``match='exact'`` (training): late/early are means of the listed answers
    only when all of them exist, else 0 (R8). ``'prefix'`` (serving): mean of
    every column starting with a listed name.
    """
    p = FAM.family(cols, "P")
    if not p:
        return {}
    spec = {"P_mean": ("mean", p), "P_std": ("std", p)}
    if full:
        spec.update({"P_min": ("min", p), "P_max": ("max", p)})
    for name, group in (("P_late", FAM.LATE_GROUP), ("P_early", FAM.EARLY_GROUP)):
        if match == "exact":
            members = list(group) if FAM.all_present(cols, group) else []
        else:
            members = FAM.group_columns(cols, group, "prefix")
        spec[name] = ("mean", members)
    return spec


def time_spec(cols, full: bool = True) -> dict:
    """E5: T mean/std/min/max."""
    t = FAM.family(cols, "T")
    if not t:
        return {}
    spec = {"T_mean": ("mean", t), "T_std": ("std", t)}
    if full:
        spec.update({"T_min": ("min", t), "T_max": ("max", t)})
    return spec


def form_spec(cols) -> dict:
    """profile/sleep/final mean+std and the overall F mean."""
    f = FAM.family(cols, "F")
    spec = {}
    for prefix, name in ((FAM.F_PROFILE_PREFIXES, "F_perfil"), (FAM.F_SLEEP_PREFIX, "F_sono"),
                         (FAM.F_FINAL_PREFIX, "F_final")):
        sub = FAM.by_prefix(f, prefix)
        if sub:
            spec[f"{name}_mean"] = ("mean", sub)
            spec[f"{name}_std"] = ("std", sub)
    spec["F_mean_geral"] = ("mean", f)
    return spec


def target1_features(df: DataFrame, sleep_median: float | None, match: str = "exact") -> DataFrame:
    """E1 + E4 (+ range) + E5 + E6 — the target-1 feature plan."""
    df = sleep_set_a(df, sleep_median)
    spec = {**performance_spec(df.columns, match), **time_spec(df.columns), **form_spec(df.columns)}
    out = with_row_stats(df, spec)
    if "P_max" in out.columns:
        late = [c for c in out.columns if c not in ("P_late", "P_early")]
        out = out.withColumn("P_range", F.expr("P_max - P_min"))
        # keep the documented column order: range follows max
        order = []
        for c in late:
            order.append(c)
            if c == "P_max":
                order.append("P_range")
        order += [c for c in ("P_late", "P_early") if c in out.columns]
        have = set(out.columns)
        out = out.select(*[q(c) for c in order if c in have])
    return out


def target2_features(df: DataFrame) -> DataFrame:
    """E2 + sleep/final F means + P mean (target-2 plan)."""
    df = sleep_set_b(df)
    f = FAM.family(df.columns, "F")
    spec = {}
    if sub := FAM.by_prefix(f, FAM.F_SLEEP_PREFIX):
        spec["F_sono_mean"] = ("mean", sub)
    if sub := FAM.by_prefix(f, FAM.F_FINAL_PREFIX):
        spec["F_final_mean"] = ("mean", sub)
    if p := FAM.family(df.columns, "P"):
        spec["P_mean"] = ("mean", p)
    return with_row_stats(df, spec)


def target3_features(df: DataFrame, match: str = "exact") -> DataFrame:
    """E3 + E4 (mean/std/late/early) + E5 (mean/std) + final mean by substring (P5)."""
    cols = df.columns
    spec = {**performance_spec(cols, match, full=False), **time_spec(cols, full=False)}
    f = FAM.family(cols, "F")  # defined before use (Q10)
    extra = {}
    if "QtdHorasSono" in cols:
        if sub := FAM.by_substring(f, "07"):
            spec.update({"F_sono_mean": ("mean", sub), "F_sono_std": ("std", sub), "F_sono_max": ("max", sub)})
        if "Acordar" in cols:
            extra = {"sono_x_acordar": _c("QtdHorasSono") * _c("Acordar"),
                     "acordar_squared": _c("Acordar") * _c("Acordar")}
    if sub := FAM.by_substring(f, "11"):
        spec["F_final_mean"] = ("mean", sub)
    out = with_row_stats(df, spec)
    return out.withColumns(extra) if extra else out


def cluster_features(df: DataFrame) -> DataFrame:
    """P mean/std/max, T mean/total, F sleep/final means."""
    cols = df.columns
    spec = {}
    if p := FAM.family(cols, "P"):
        spec.update({"P_mean": ("mean", p), "P_std": ("std", p), "P_max": ("max", p)})
    if t := FAM.family(cols, "T"):
        spec.update({"T_mean": ("mean", t), "T_total": ("sum", t)})
    f = FAM.family(cols, "F")
    if sub := FAM.by_prefix(f, FAM.F_SLEEP_PREFIX):
        spec["F_sono_mean"] = ("mean", sub)
    if sub := FAM.by_prefix(f, FAM.F_FINAL_PREFIX):
        spec["F_final_mean"] = ("mean", sub)
    return with_row_stats(df, spec)


CLUSTER_FEATURES = ("P_mean", "P_std", "T_mean", "F_sono_mean", "F_final_mean")


def interaction_names(ranked, k: int) -> list[str]:
    """``{a}_X_{b}`` for pairs among the first ``k`` ranked features."""
    top = [f for f in ranked if "_X_" not in f][:k]
    return [f"{a}_X_{b}" for i, a in enumerate(top) for b in top[i + 1:]]


def add_interactions(df: DataFrame, names) -> DataFrame:
    """Products for ``a_X_b`` names; a missing input gives 0 (serving rule)."""
    exprs = {}
    for name in names:
        a, b = name.split("_X_", 1)
        if a in df.columns and b in df.columns:
            exprs[name] = _c(a) * _c(b)
        else:
            exprs[name] = F.lit(0.0)
    return df.withColumns(exprs) if exprs else df


def named_interaction(df: DataFrame, a: str = "F1103", b: str = "P_mean", wanted=None) -> DataFrame:
    """One explicit product when both exist (and, if given, it is wanted)."""
    name = f"{a}_X_{b}"
    if a in df.columns and b in df.columns and (wanted is None or name in wanted):
        return df.withColumn(name, _c(a) * _c(b))
    return df
