"""Column statistics and profiling.

Rule: every statistic over many columns is one wide ``agg`` (one scan, with
map-side partial aggregation), and reports are produced by turning that one
row into a long table with ``inline(array(struct…))`` — the data never leaves
the cluster. Only one-row results (a handful of numbers per column) are ever
brought to the driver, by the fit-style helpers that need literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.sqltext import lit, q
from . import quantile as Q


def col_(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def round_binary(c, scale: int):
    """Round the binary value half away from zero (``round(x·10^s)/10^s``);
    ``round(x, s)`` rounds the shortest decimal string instead. ``c`` is a
    Column, or SQL text (then SQL text is returned)."""
    f = float(10 ** scale)
    if isinstance(c, str):
        return f"(round(({c}) * {lit(f)}) / {lit(f)})"
    return F.round(c * f) / f


def to_long(one_row: DataFrame, rows: list[dict]) -> DataFrame:
    """Turn a one-row aggregate into a long table.

    ``rows``: one dict per output row, mapping output field → Column over the
    one-row frame, or → SQL text (then the whole report is one ``selectExpr``,
    parsed once, instead of a JVM call per field). All dicts must have the same
    keys and compatible types.
    """
    if all(isinstance(v, str) for r in rows for v in r.values()):
        structs = ["named_struct(" + ", ".join(f"{lit(k)}, {v}" for k, v in r.items()) + ")" for r in rows]
        return one_row.selectExpr(f"inline(array({', '.join(structs)}))")
    structs = [F.struct(*[(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in r.items()])
               for r in rows]
    return one_row.select(F.inline(F.array(*structs)))


#: Most aggregate expressions in one pass: beyond it the generated code of a
#: very wide table would not compile.
PASS_EXPRESSIONS = 200


def wide_agg(df: DataFrame, aggs: list[Column], chunk: int = PASS_EXPRESSIONS) -> DataFrame:
    """One row of many global aggregates. Up to ``chunk`` of them are one lazy
    aggregate; a wider list runs in passes whose few numbers come back as
    literals (one number per expression reaches the driver)."""
    if len(aggs) <= chunk:
        return df.agg(*aggs)
    values = {}
    fields = []
    for i in range(0, len(aggs), chunk):
        part = df.agg(*aggs[i:i + chunk])
        values.update(part.first().asDict())
        fields += part.schema.fields
    return df.sparkSession.createDataFrame([tuple(values[f.name] for f in fields)], StructType(fields))


# --------------------------------------------------------------------------
# counts, missing, conditional counts
# --------------------------------------------------------------------------

def missing_profile(df: DataFrame, cols=None, only_missing: bool = True) -> DataFrame:
    """A2: (Coluna, Missing, Percentual) — percent rounded to 2 decimals,
    only columns with missing values, sorted by percent descending."""
    cols = list(cols or df.columns)
    aggs = [F.expr("count(1)").alias("__n")]
    aggs += [F.expr(f"count_if({q(c)} IS NULL)").alias(f"__m{i}") for i, c in enumerate(cols)]
    one = wide_agg(df, aggs)
    rows = [{"Coluna": lit(c), "Missing": f"__m{i}",
             "Percentual": round_binary(f"__m{i} * 100D / __n", 2)}
            for i, c in enumerate(cols)]
    out = to_long(one, rows)
    if only_missing:
        out = out.filter(F.col("Missing") > 0)
    return out.orderBy(F.desc("Percentual"), F.asc("Coluna"))


def sparse_columns(df: DataFrame, cols=None, threshold: float = 70.0, protect=()) -> list[str]:
    """A3: names whose rounded missing percent exceeds ``threshold``.

    Reads the one-row missing aggregate only (one number per column).
    """
    cols = [c for c in (cols or df.columns) if c not in set(protect)]
    prof = missing_profile(df, cols, only_missing=True)
    return [r["Coluna"] for r in prof.filter(F.col("Percentual") > threshold).collect()]


def drop_sparse(df: DataFrame, threshold: float = 70.0, protect=()) -> DataFrame:
    """``df`` without the columns whose missing percent exceeds
    ``threshold``; protected columns (targets, ids) stay."""
    return df.drop(*sparse_columns(df, threshold=threshold, protect=protect))


def count_where(df: DataFrame, conds: dict) -> DataFrame:
    """A4: one row of ``count_if`` results, one column per named condition."""
    return wide_agg(df, [F.count_if(c).alias(name) for name, c in conds.items()])


# --------------------------------------------------------------------------
# variance, correlation
# --------------------------------------------------------------------------

def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson on rows where both are present (N4); NULL when either side is
    constant or empty instead of an ANSI divide-by-zero (N3)."""
    xs = F.when(y.isNotNull(), x)
    ys = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def variance_table(df: DataFrame, cols, fill_zero: bool = True, threshold: float | None = None) -> DataFrame:
    """(feature, variance[, kept]) with population variance; optional
    zero fill first (as the target-1 variance step does)."""
    cols = list(cols)
    def v(c):
        x = F.coalesce(col_(c).cast("double"), F.lit(0.0)) if fill_zero else col_(c).cast("double")
        return F.var_pop(x)
    one = wide_agg(df, [v(c).alias(f"__v{i}") for i, c in enumerate(cols)])
    rows = [{"feature": F.lit(c), "variance": F.col(f"__v{i}")} for i, c in enumerate(cols)]
    out = to_long(one, rows)
    if threshold is not None:
        out = out.withColumn("kept", F.col("variance") > F.lit(threshold))
    return out


def feature_long(df: DataFrame, features, keep: dict | None = None) -> DataFrame:
    """(keep…, feature, x): one row per (input row, feature).

    Used for per-feature statistics that need several aggregate buffers each
    (correlations): grouping the long frame by ``feature`` keeps the generated
    code the same size whatever the number of features, and the explode is
    pipelined into the map-side partial aggregation (only one partial row per
    feature and task crosses the shuffle).
    """
    keep = keep or {}
    structs = [F.struct(F.lit(f).alias("feature"), col_(f).cast("double").alias("x")) for f in features]
    return (df.select(*[c.alias(n) for n, c in keep.items()], F.explode(F.array(*structs)).alias("__s"))
            .select(*keep.keys(), "__s.feature", "__s.x"))


def _target_cols(targets) -> dict:
    return {f"__y{j}": col_(t).cast("double") for j, t in enumerate(targets)}


def corr_with_targets(df: DataFrame, features, targets) -> DataFrame:
    """A10: long table (feature, target, corr, abs_corr), one grouped pass."""
    features, targets = list(features), list(targets)
    lng = feature_long(df, features, _target_cols(targets))
    agg = lng.groupBy("feature").agg(*[guarded_corr(F.col("x"), F.col(f"__y{j}")).alias(f"__c{j}")
                                       for j in range(len(targets))])
    parts = F.array(*[F.struct(F.lit(t).alias("target"), F.col(f"__c{j}").alias("corr"))
                      for j, t in enumerate(targets)])
    out = agg.select("feature", F.inline(parts))
    return out.withColumn("abs_corr", F.abs("corr"))


def corr_report(df: DataFrame, features, targets, threshold: float = 0.20) -> DataFrame:
    """One row per feature with |corr| per target, their mean
    (NULL if any is NULL), and whether the mean passes ``threshold``."""
    features, targets = list(features), list(targets)
    lng = feature_long(df, features, _target_cols(targets))
    out = lng.groupBy(F.col("feature").alias("Feature")).agg(
        *[F.abs(guarded_corr(F.col("x"), F.col(f"__y{j}"))).alias(f"Corr_{t}") for j, t in enumerate(targets)])
    mean = sum(F.col(f"Corr_{t}") for t in targets) / len(targets)
    out = out.withColumn("Corr_Media", mean)
    return out.withColumn("Mantida", F.coalesce(F.col("Corr_Media") > threshold, F.lit(False)))


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """k×k guarded correlations, long form (row_feature, col_feature, corr)."""
    cols = list(cols)
    aggs, rows = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            name = f"__r{i}_{j}"
            aggs.append(guarded_corr(col_(a).cast("double"), col_(b).cast("double")).alias(name))
    one = wide_agg(df, aggs)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            name = f"__r{min(i, j)}_{max(i, j)}"
            rows.append({"row_feature": F.lit(a), "col_feature": F.lit(b), "corr": F.col(name)})
    return to_long(one, rows)


# --------------------------------------------------------------------------
# describe, five-number summary
# --------------------------------------------------------------------------

def describe(df: DataFrame, cols, method: str = "exact") -> DataFrame:
    """Count, mean, std (ddof 1), min, 25/50/75 % (exact, interpolated), max."""
    cols = list(cols)
    # one pass for the moments, then the exact quantiles; the report is built
    # from these few numbers per column
    base = wide_agg(df, [F.expr(e).alias(f"__{k}{i}") for i, c in enumerate(cols) for k, e in (
        ("n", f"count({q(c)})"), ("a", f"avg({q(c)})"), ("s", f"stddev_samp({q(c)})"),
        ("lo", f"CAST(min({q(c)}) AS DOUBLE)"), ("hi", f"CAST(max({q(c)}) AS DOUBLE)"))]).first()
    qs = Q.quantile_values(df, cols, [0.25, 0.5, 0.75], method=method)

    def num(v, cast="DOUBLE"):
        return f"CAST({lit(None if v is None else (int(v) if cast == 'BIGINT' else float(v)))} AS {cast})"
    rows = [{"column": lit(c), "count": num(base[f"__n{i}"], "BIGINT"), "mean": num(base[f"__a{i}"]),
             "std": num(base[f"__s{i}"]), "min": num(base[f"__lo{i}"]),
             "q25": num(qs[c][0]), "q50": num(qs[c][1]), "q75": num(qs[c][2]),
             "max": num(base[f"__hi{i}"])} for i, c in enumerate(cols)]
    return to_long(df.sparkSession.range(1), rows)


def five_numbers(df: DataFrame, cols, method: str = "exact") -> DataFrame:
    """Box-plot data — quartiles, 1.5·IQR fences, whiskers (most extreme
    points inside the fences) and the count of points outside."""
    cols = list(cols)
    qs = Q.quantile_values(df, cols, [0.25, 0.5, 0.75], method=method)
    aggs, rows = [], []
    for i, c in enumerate(cols):
        q1, med, q3 = qs[c]
        if q1 is None:
            lo = hi = None
        else:
            lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        x = col_(c).cast("double")
        inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
        aggs += [F.min(F.when(inside, x)).alias(f"__wl{i}"), F.max(F.when(inside, x)).alias(f"__wh{i}"),
                 F.count_if((x < F.lit(lo)) | (x > F.lit(hi))).alias(f"__o{i}")]
        rows.append({"column": F.lit(c), "q1": F.lit(q1).cast("double"), "median": F.lit(med).cast("double"),
                     "q3": F.lit(q3).cast("double"), "lower_fence": F.lit(lo).cast("double"),
                     "upper_fence": F.lit(hi).cast("double"), "whisker_low": F.col(f"__wl{i}"),
                     "whisker_high": F.col(f"__wh{i}"), "n_outliers": F.col(f"__o{i}")})
    return to_long(wide_agg(df, aggs), rows)


def histogram(df: DataFrame, cols, bins: int = 20) -> DataFrame:
    """Fixed-width bins per column, long form (column, bin, lo, hi, count).

    Min/max come from one aggregate; the binning is a single ``groupBy`` on
    (column, bin) with map-side combine — output is at most cols × bins rows.
    """
    cols = list(cols)
    mm = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.min(col_(c)).cast("double").alias(f"lo{i}"), F.max(col_(c)).cast("double").alias(f"hi{i}"))]).first()
    parts = []
    for i, c in enumerate(cols):
        lo, hi = mm[f"lo{i}"], mm[f"hi{i}"]
        if lo is None:
            continue
        width = (hi - lo) / bins if hi > lo else 1.0
        x = col_(c).cast("double")
        b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
        parts.append(F.struct(F.lit(c).alias("column"), b.alias("bin"),
                              F.lit(lo).alias("__lo"), F.lit(width).alias("__w")))
    longf = df.select(F.explode(F.array(*parts)).alias("s")).select("s.*").filter(F.col("bin").isNotNull())
    out = longf.groupBy("column", "bin").agg(F.count(F.lit(1)).alias("count"),
                                           F.first("__lo").alias("__lo"), F.first("__w").alias("__w"))
    return out.select("column", "bin", (F.col("__lo") + F.col("bin") * F.col("__w")).alias("bin_lo"),
                      (F.col("__lo") + (F.col("bin") + 1) * F.col("__w")).alias("bin_hi"), "count")
