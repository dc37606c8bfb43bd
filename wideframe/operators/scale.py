"""Scalers with exact statistics.

MLlib's StandardScaler uses the sample std and its RobustScaler is not
interpolated, so the fitted numbers here come from one exact aggregate and the
transform is a projection with literals.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quantile as Q
from ..functions.sqltext import lit, q
from .profile import col_


@dataclass
class AffineModel:
    """x → (x − center) / scale per column."""
    center: dict
    scale: dict

    def transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        exprs = {c: F.expr(f"(CAST({q(c)} AS DOUBLE) - {lit(self.center[c])}) / {lit(self.scale[c])}")
                 for c in self.center if c in have}
        return df.withColumns(exprs) if exprs else df


class StandardScaler:
    """Population std; zero (or undefined) std → 1."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> AffineModel:
        row = df.agg(*[e for i, c in enumerate(self.cols) for e in (
            F.avg(col_(c)).alias(f"m{i}"), F.stddev_pop(col_(c)).alias(f"s{i}"))]).first()
        center, scale = {}, {}
        for i, c in enumerate(self.cols):
            m, s = row[f"m{i}"], row[f"s{i}"]
            center[c] = 0.0 if m is None else float(m)
            scale[c] = 1.0 if (s is None or s == 0 or math.isnan(s)) else float(s)
        return AffineModel(center, scale)


class RobustScaler:
    """(x − median) / (Q3 − Q1), exact interpolated quartiles; IQR 0 → 1."""

    def __init__(self, cols, method: str = "exact"):
        self.cols, self.method = list(cols), method

    def fit(self, df: DataFrame) -> AffineModel:
        qs = Q.quantile_values(df, self.cols, [0.25, 0.5, 0.75], method=self.method)
        center, scale = {}, {}
        for c in self.cols:
            q1, med, q3 = qs[c]
            center[c] = 0.0 if med is None else float(med)
            iqr = None if q1 is None else q3 - q1
            scale[c] = 1.0 if (iqr is None or iqr == 0) else float(iqr)
        return AffineModel(center, scale)


# --------------------------------------------------------------------------
# Z3 quantile transform to a normal distribution
# --------------------------------------------------------------------------

# Coefficients of the published rational approximation of the
# inverse normal CDF (P. J. Acklam), relative error about 1.15e-9.
_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
      1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
      6.680131188771972e+01, -1.328068155288572e+01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
      -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
      3.754408661907416e+00)
_P_LOW = 0.02425
# Clip bounds for the uniform value before the inverse CDF.
_BOUNDS = 1e-7


def norm_ppf(p: np.ndarray) -> np.ndarray:
    p = np.asarray(p, dtype=float)
    out = np.empty_like(p)
    lo = p < _P_LOW
    hi = p > 1 - _P_LOW
    mid = ~(lo | hi)
    if mid.any():
        q = p[mid] - 0.5
        r = q * q
        num = (((((_A[0] * r + _A[1]) * r + _A[2]) * r + _A[3]) * r + _A[4]) * r + _A[5]) * q
        den = ((((_B[0] * r + _B[1]) * r + _B[2]) * r + _B[3]) * r + _B[4]) * r + 1
        out[mid] = num / den
    for mask, sign, src in ((lo, 1.0, p), (hi, -1.0, 1 - p)):
        if mask.any():
            q = np.sqrt(-2 * np.log(src[mask]))
            num = ((((_C[0] * q + _C[1]) * q + _C[2]) * q + _C[3]) * q + _C[4]) * q + _C[5]
            den = (((_D[0] * q + _D[1]) * q + _D[2]) * q + _D[3]) * q + 1
            out[mask] = sign * num / den
    return out


def uniform_from_quantiles(x: np.ndarray, quantiles: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Empirical CDF by interpolation, averaged over both directions so that
    repeated quantiles map to the middle of their reference range."""
    up = np.interp(x, quantiles, refs)
    down = -np.interp(-x, -quantiles[::-1], -refs[::-1])
    u = 0.5 * (up + down)
    u = np.where(x <= quantiles[0], 0.0, u)
    u = np.where(x >= quantiles[-1], 1.0, u)
    return u


def _poly(coefs, x: str) -> str:
    return "(" * (len(coefs) - 1) + f"({coefs[0]!r}D)" + "".join(f" * {x} + ({c!r}D))" for c in coefs[1:])


def ppf_sql(u: str) -> str:
    """SQL of ``norm_ppf`` for a column ``u`` strictly between 0 and 1."""
    tail = lambda p: f"({_poly(_C, f'sqrt(-2D * ln({p}))')} / {_poly(_D + (1.0,), f'sqrt(-2D * ln({p}))')})"
    r = f"(({u} - 0.5D) * ({u} - 0.5D))"
    return (f"CASE WHEN {u} < {_P_LOW!r}D THEN {tail(u)} WHEN {u} > {1 - _P_LOW!r}D THEN -{tail(f'(1D - {u})')} "
            f"ELSE {_poly(_A, r)} * ({u} - 0.5D) / {_poly(_B + (1.0,), r)} END")


@dataclass
class QuantileNormalModel:
    quantiles: dict  # column -> list of n_quantiles values
    refs: list
    output: str = "normal"

    def transform(self, df: DataFrame) -> DataFrame:
        """Built-in functions only: the sorted quantiles are an array literal,
        a value's neighbours are found in it by halving steps, and both
        interpolation directions are averaged (repeated quantiles map to their
        middle)."""
        n = len(self.refs)
        cols = {c: [float(v) for v in qs] for c, qs in self.quantiles.items()
                if c in df.columns and qs is not None and qs[0] is not None}
        if not cols:
            return df
        out = df
        for i, (c, qs) in enumerate(cols.items()):
            as_array = lambda vs: "CAST(split('" + ",".join(map(repr, vs)) + "', ',') AS ARRAY<DOUBLE>)"
            # interpolated quantiles can be out of order in their last bit: counts come from a sorted copy
            table, ordered = as_array(qs), as_array(sorted(qs))
            steps = "array(" + ", ".join(str(1 << b) for b in reversed(range(n.bit_length()))) + ")"
            below = lambda op: f"aggregate({steps}, 0, (a, s) -> IF(a + s <= {n} AND {ordered}[least(a + s, {n}) - 1] {op} x, a + s, a))"
            step = repr(1 / (n - 1)) + "D"
            # j: last quantile at or below x, k: first at or above (0-based)
            j = f"{below('<=')} - 1"
            k = below("<")
            body = (f"CASE WHEN x IS NULL OR isnan(x) THEN NULL WHEN x <= {qs[0]!r}D THEN 0D WHEN x >= {qs[-1]!r}D THEN 1D ELSE "
                    f"transform(array(named_struct('j', {j}, 'k', {k})), p -> 0.5D * ("
                    f"p.j * {step} + IF({table}[p.j] = x, 0D, {step} * (x - {table}[p.j]) / ({table}[p.j + 1] - {table}[p.j])) + "
                    f"p.k * {step} - IF({table}[p.k] = x, 0D, {step} * ({table}[p.k] - x) / ({table}[p.k] - {table}[p.k - 1]))))[0] END")
            uniform = f"transform(array(CAST({q(c)} AS DOUBLE)), x -> {body})[0]"
            if self.output == "normal":
                clipped = f"greatest({_BOUNDS!r}D, least({1 - _BOUNDS!r}D, u))"
                uniform = (f"transform(array({uniform}), w -> IF(w IS NULL, NULL, "
                           f"transform(array({clipped.replace('u)', 'w)')}), u -> {ppf_sql('u')})[0]))[0]")
            out = out.withColumn(c, F.expr(uniform))
        return out


class QuantileNormalizer:
    """Z3 fit: ``n_quantiles`` exact quantiles per column. More quantiles than
    values carry no information, so the number is at most the largest count of
    non-null values of a column (the usual rule of this transform)."""

    def __init__(self, cols, n_quantiles: int = 1000, output: str = "normal", method: str = "exact"):
        self.cols, self.n, self.output, self.method = list(cols), n_quantiles, output, method

    def fit(self, df: DataFrame) -> QuantileNormalModel:
        counts = df.agg(*[F.count(col_(c)).alias(f"n{i}") for i, c in enumerate(self.cols)]).first()
        n = max(2, min(self.n, max(counts)))
        refs = [i / (n - 1) for i in range(n)]
        qs = Q.quantile_values(df, self.cols, refs, method=self.method)
        return QuantileNormalModel({c: qs[c] for c in self.cols}, refs, self.output)
