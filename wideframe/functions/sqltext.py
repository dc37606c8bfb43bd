"""SQL text for generated column expressions.

Wide tables need expressions over tens to hundreds of columns (row means, pivots,
one rounding per output column). Built with the ``Column`` API, each ``col``,
``lit`` and operator is a separate call into the JVM, so one row statistic over
20 columns costs hundreds of round trips before any job runs. The same
expression written as SQL text is parsed once by Catalyst (``F.expr`` /
``selectExpr``): the plan is identical, only the driver work shrinks.
"""

from __future__ import annotations

import datetime as _dt
import math
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Quoted identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit(v) -> str:
    """SQL literal with the type a Python value would get from ``F.lit``."""
    if v is None:
        return "NULL"
    if hasattr(v, "item") and not isinstance(v, (float, int)):  # NumPy scalar
        return lit(v.item())
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(int(v))
    if isinstance(v, float):
        if math.isnan(v):
            return "CAST('NaN' AS DOUBLE)"
        if math.isinf(v):
            return "CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)"
        v = float(v)  # repr of a NumPy float is not a number literal
        return f"{v!r}D" if v >= 0 else f"({v!r}D)"
    if isinstance(v, Decimal):
        return f"{v}BD" if v >= 0 else f"({v}BD)"
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(type(v))


def plus(terms) -> str:
    """``(t1 + t2 + …)``, left-associative like ``functools.reduce``."""
    return "(" + " + ".join(terms) + ")"


def expr(text: str) -> Column:
    return F.expr(text)
