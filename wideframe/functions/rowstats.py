"""Row-wise (across columns) statistics as generated column expressions.

Semantics follow pandas ``axis=1`` reductions: NULLs are skipped, the mean
divides by the non-null count, the standard deviation uses ddof=1 and is NULL
below two values, and an empty column list gives the constant 0.

Expressions are generated as SQL text (one parse per output column instead of
a JVM call per operand, see ``sqltext``); the ``*_sql`` builders return the
text so that callers can compose it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from .sqltext import expr, plus, q

ZERO = "0D"


def row_count_sql(cols) -> str:
    return plus([f"CAST({q(c)} IS NOT NULL AS INT)" for c in cols])


def row_sum_sql(cols) -> str:
    if not cols:
        return ZERO
    return plus([f"coalesce(CAST({q(c)} AS DOUBLE), 0D)" for c in cols])


def row_mean_sql(cols, min_columns: int = 1) -> str:
    if not cols or len(cols) < min_columns:
        return ZERO
    return f"({row_sum_sql(cols)} / nullif({row_count_sql(cols)}, 0))"


def row_min_sql(cols) -> str:
    if not cols:
        return ZERO
    if len(cols) == 1:
        return f"CAST({q(cols[0])} AS DOUBLE)"
    return f"CAST(least({', '.join(q(c) for c in cols)}) AS DOUBLE)"


def row_max_sql(cols) -> str:
    if not cols:
        return ZERO
    if len(cols) == 1:
        return f"CAST({q(cols[0])} AS DOUBLE)"
    return f"CAST(greatest({', '.join(q(c) for c in cols)}) AS DOUBLE)"


def row_var_from_mean_sql(cols, mean_col: str) -> str:
    if not cols:
        return ZERO
    m = q(mean_col)
    sq = plus([f"coalesce(({q(c)} - {m}) * ({q(c)} - {m}), 0D)" for c in cols])
    n = row_count_sql(cols)
    return f"CASE WHEN {n} >= 2 THEN {sq} / ({n} - 1) END"


def row_count(cols) -> Column:
    return expr(row_count_sql(cols))


def row_sum(cols) -> Column:
    """Nulls count as 0."""
    return expr(row_sum_sql(cols))


def row_mean(cols, min_columns: int = 1) -> Column:
    """R1 (R7 with ``min_columns``): mean of non-null cells; 0 if no column."""
    return expr(row_mean_sql(cols, min_columns))


def row_min(cols) -> Column:
    """``least`` skips NULLs like pandas."""
    return expr(row_min_sql(cols))


def row_max(cols) -> Column:
    """R4."""
    return expr(row_max_sql(cols))


def row_std_from_mean(cols, mean_col: str) -> Column:
    """R2 (variance) given an already projected row mean column (keeps the tree O(k))."""
    return expr(row_var_from_mean_sql(cols, mean_col))


_FIRST = {"mean": row_mean_sql, "sum": row_sum_sql, "min": row_min_sql, "max": row_max_sql}


def with_row_stats(df: DataFrame, spec: dict) -> DataFrame:
    """Add many row statistics with two projections.

    ``spec``: ``{out_name: (kind, cols)}`` with kind in mean/std/min/max/sum.
    Means are computed in the first projection; standard deviations reuse them
    in the second, so no mean expression is repeated per column.
    """
    first, helpers, second = {}, {}, {}
    for name, (kind, cols) in spec.items():
        cols = list(cols)
        if kind in _FIRST:
            first[name] = expr(_FIRST[kind](cols))
        elif kind == "std":
            if not cols:
                first[name] = expr(ZERO)
                continue
            h = f"__mean_{name}"
            helpers[h] = expr(row_mean_sql(cols))
            second[name] = expr(f"sqrt({row_var_from_mean_sql(cols, h)})")
        else:
            raise ValueError(kind)
    out = df.withColumns({**first, **helpers}) if (first or helpers) else df
    if second:
        out = out.withColumns(second)
    keep = [c for c in df.columns if c not in spec] + list(spec)
    return out.select(*[q(c) for c in keep])
