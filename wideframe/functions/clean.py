"""Scalar cleaning expressions (L1–L11). All JVM-side, codegen friendly.

Rules take a column name (or ``Sql`` text) and are generated as SQL text: one
parse per column instead of a JVM call per operand (see ``sqltext``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from .sqltext import lit, q

# The skip answer, and the plausible range kept for non-targets.
SKIP_ANSWER = -1
RANGE_LOW = -100
RANGE_HIGH = 10000


class Sql(str):
    """SQL text of an expression (as opposed to a column name), so that rules
    compose as text: ``null_sentinel(to_number("x", as_sql=True))``."""


def _x(c) -> str:
    if isinstance(c, Sql):
        return "(" + c + ")"
    if isinstance(c, str):
        return q(c)
    raise TypeError("pass a column name or Sql text")


def _out(text: str, as_sql: bool):
    return Sql(text) if as_sql else F.expr(text)


def no_nan(c, as_sql: bool = False):
    """NaN → NULL (N1): Spark sorts NaN above every number and avg() spreads it."""
    x = _x(c)
    return _out(f"CASE WHEN NOT isnan({x}) THEN {x} END", as_sql)


def decimal_comma(c, strict: bool = False, as_sql: bool = False):
    """L1: ``'1,5'`` → 1.5. Strict raises on bad text (ANSI cast); default coerces to NULL."""
    s = f"regexp_replace(CAST({_x(c)} AS STRING), ',', '.')"
    num = Sql(f"CAST({s} AS DOUBLE)" if strict else f"try_cast({s} AS DOUBLE)")
    return no_nan(num, as_sql)


def to_number(c, dtype=None, as_sql: bool = False):
    """L2: coerce to double; unparseable text → NULL."""
    x = _x(c)
    if dtype is not None and isinstance(dtype, NumericType):
        return no_nan(Sql(f"CAST({x} AS DOUBLE)"), as_sql)
    if dtype is not None and not isinstance(dtype, StringType):
        return _out(f"try_cast({x} AS DOUBLE)", as_sql)
    return no_nan(Sql(f"try_cast(CAST({x} AS STRING) AS DOUBLE)"), as_sql)


def null_sentinel(c, value=SKIP_ANSWER, as_sql: bool = False):
    """L3: the skip answer becomes NULL."""
    x = _x(c)
    return _out(f"CASE WHEN {x} != {lit(value)} THEN {x} END", as_sql)


def null_negative(c, as_sql: bool = False):
    """L4: every negative becomes NULL."""
    x = _x(c)
    return _out(f"CASE WHEN {x} >= 0 THEN {x} END", as_sql)


def range_guard(c, low=RANGE_LOW, high=RANGE_HIGH, as_sql: bool = False):
    """Values < low or > high become NULL."""
    x = _x(c)
    return _out(f"CASE WHEN ({x} >= {lit(low)}) AND ({x} <= {lit(high)}) THEN {x} END", as_sql)


def round_half_even(c, scale: int = 2, as_sql: bool = False):
    """banker's rounding like NumPy ``round`` (0.125 → 0.12)."""
    return _out(f"bround({_x(c)}, {int(scale)})", as_sql)


def nan_safe(c, as_sql: bool = False):
    """NULL → 0.0 for reports."""
    return _out(f"coalesce(CAST({_x(c)} AS DOUBLE), 0D)", as_sql)


def format_ts(c, as_sql: bool = False):
    """``YYYY-MM-DD HH:MM:SS``."""
    return _out(f"date_format({_x(c)}, 'yyyy-MM-dd HH:mm:ss')", as_sql)


def id_string(c, as_sql: bool = False):
    """L11."""
    return _out(f"CAST({_x(c)} AS STRING)", as_sql)


def coerce_columns(df: DataFrame, cols, decimal_comma_cols=()) -> DataFrame:
    """Apply L1/L2 to many columns in one projection."""
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for c in cols:
        if c in decimal_comma_cols:
            exprs[c] = decimal_comma(c)
        else:
            exprs[c] = to_number(c, types.get(c))
    return df.withColumns(exprs) if exprs else df


def apply_to(df: DataFrame, cols, fn) -> DataFrame:
    """One ``withColumns`` (one Project) for a per-column expression."""
    cols = list(cols)
    return df.withColumns({c: fn(c) for c in cols}) if cols else df
