"""Shared preparation stages over a wide player table.

Each stage is a DataFrame → DataFrame step (plus fitted state where it needs
statistics). The stages are what the training scripts and the scoring service
of the original project do in pandas; here they are projections and one-pass
aggregates.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as C
from ..functions import families as FAM
from ..operators.impute import FillModel, MedianImputer
from ..operators.profile import col_

DECIMAL_COMMA_COLUMNS = ("F0103",)


def materialize(df: DataFrame) -> DataFrame:
    """Keep a table that several statistics passes read.

    Memory-and-disk persistence; lost blocks are recomputed from lineage when
    an executor goes away. Long chains are cut with ``session.cut_lineage``.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def coerce_families(df: DataFrame, targets=FAM.TARGET_COLUMNS) -> DataFrame:
    """L1 + L2 on the decimal-comma column and every P/T/F column."""
    fam = FAM.all_family_columns(df.columns)
    cols = [c for c in fam if c not in targets]
    dc = [c for c in DECIMAL_COMMA_COLUMNS if c in df.columns]
    return C.coerce_columns(df, list(dict.fromkeys(dc + cols)), decimal_comma_cols=dc)


ID_COLUMNS = ("player_id", FAM.ID_COLUMN)


def guard_ranges(df: DataFrame, targets=FAM.TARGET_COLUMNS, exclude=ID_COLUMNS) -> DataFrame:
    """L5 on numeric non-target, non-id columns."""
    cols = [c for c in FAM.numeric_columns(df, exclude=tuple(targets) + tuple(exclude))]
    return C.apply_to(df, cols, C.range_guard)


def null_skips(df: DataFrame, cols) -> DataFrame:
    """L3."""
    return C.apply_to(df, cols, C.null_sentinel)


def skip_rates(df: DataFrame, mode: str = "reference") -> DataFrame:
    """A5: share of skip answers (-1) in the P and T families, before nulling.

    ``reference``: (−1 cells in the whole table) / (number of columns) — the
    same scalar on every row (Q1). Computed as one global aggregate read back
    as a scalar subquery (one struct, so the aggregate runs once; no join).
    ``row``: per-row share of −1 among the row's family columns.
    """
    p = FAM.family(df.columns, "P")
    t = FAM.family(df.columns, "T")
    def ones(cols):
        return sum((F.coalesce(col_(c) == -1, F.lit(False))).cast("int") for c in cols) if cols else F.lit(0)
    if mode == "row":
        out = {"taxa_pulos_P": (ones(p) / F.lit(len(p))) if p else F.lit(0.0),
               "taxa_pulos_T": (ones(t) / F.lit(len(t))) if t else F.lit(0.0)}
        total = len(p) + len(t)
        out["taxa_pulos_geral"] = ((ones(p) + ones(t)) / F.lit(total)) if total else F.lit(0.0)
        return df.withColumns({k: v.cast("double") for k, v in out.items()})
    summary = skip_rate_summary(df)
    rates = summary.select(F.struct(*summary.columns).alias("s")).scalar()
    return df.withColumns({c: rates.getField(c) for c in summary.columns})


def _ones(cols):
    return sum((F.coalesce(col_(c) == -1, F.lit(False))).cast("int") for c in cols) if cols else F.lit(0)


def skip_rate_summary(df: DataFrame) -> DataFrame:
    """A5 reference mode as a one-row frame (one global aggregate)."""
    p = FAM.family(df.columns, "P")
    t = FAM.family(df.columns, "T")
    ones = _ones
    one = df.agg(F.sum(ones(p)).alias("__sp"), F.sum(ones(t)).alias("__st"))
    total = len(p) + len(t)
    return one.select(
        (F.coalesce(F.col("__sp"), F.lit(0)) / F.lit(len(p))).cast("double").alias("taxa_pulos_P") if p else F.lit(0.0).alias("taxa_pulos_P"),
        (F.coalesce(F.col("__st"), F.lit(0)) / F.lit(len(t))).cast("double").alias("taxa_pulos_T") if t else F.lit(0.0).alias("taxa_pulos_T"),
        ((F.coalesce(F.col("__sp"), F.lit(0)) + F.coalesce(F.col("__st"), F.lit(0))) / F.lit(total)).cast("double").alias("taxa_pulos_geral")
        if total else F.lit(0.0).alias("taxa_pulos_geral"))


def clean_for_training(df: DataFrame, targets=FAM.TARGET_COLUMNS, range_guard: bool = True,
                       with_skip_rates: bool = False, impute: bool = True,
                       method: str = "exact", extra_medians=()):
    """Coerce → range guard → (skip rates) → −1 to NULL → median fill of P/T/F.

    Returns ``(df, fill_model)``; targets are excluded from every step (Q2).
    ``extra_medians`` (e.g. the sleep column) are computed in the same pass and
    returned in ``fill_model.extra`` without being used for filling.
    """
    df = coerce_families(df, targets)
    if range_guard:
        df = guard_ranges(df, targets)
    if with_skip_rates:
        df = skip_rates(df)
    fam = [c for c in FAM.all_family_columns(df.columns) if c not in targets]
    df = null_skips(df, fam)
    model = None
    if impute:
        df = materialize(df)
        extra = [c for c in extra_medians if c in df.columns and c not in fam]
        fitted = MedianImputer(fam + extra, method=method).fit(df)
        values = fitted.values
        model = FillModel({c: values[c] for c in fam})
        model.extra = {c: values[c] for c in extra}
        df = model.transform(df)
    return df, model
