"""Feature selection, ranking, top-k and reshaping.

Selections read small statistic tables (one row per feature) — never data rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.sqltext import lit, q
from .profile import col_, corr_with_targets, feature_long, guarded_corr, variance_table


def variance_filter(df: DataFrame, cols, threshold: float = 0.01, fill_zero: bool = True) -> list[str]:
    """K1: features whose population variance (after zero fill) > threshold.
    MLlib's ``VarianceThresholdSelector`` uses the sample variance, hence own rule."""
    rows = variance_table(df, cols, fill_zero=fill_zero).collect()
    var = {r["feature"]: r["variance"] for r in rows}
    return [c for c in cols if var.get(c) is not None and var[c] > threshold]


def corr_ranking(df: DataFrame, features, target: str) -> DataFrame:
    """A10 + K2: (feature, abs_corr, rank) — NULL correlations dropped, ties
    broken by name (the original's stable sort used column order)."""
    c = corr_with_targets(df, features, [target]).filter(F.col("corr").isNotNull())
    # |corr| equal to 12 decimals counts as a tie (identical columns can differ
    # in the last bits with the summation order) and is broken by name
    key = F.round(F.col("abs_corr") * 1e12) / 1e12
    w = Window.orderBy(key.desc(), F.asc("feature"))  # one row per feature
    return c.select("feature", "abs_corr", F.row_number().over(w).cast("long").alias("rank"))


def variance_corr_ranking(df: DataFrame, features, target: str, threshold: float = 0.01,
                          fill_zero: bool = True) -> DataFrame:
    """K1 then A10 + K2 in one grouped pass: per feature the population variance
    (after zero fill, as ``variance_filter``) and the guarded correlation with
    ``target`` (on unfilled values, Q20) come from the same long-frame
    aggregation; features at or below ``threshold`` are dropped and the rest
    ranked as ``corr_ranking`` does. One job instead of two; the driver sees
    nothing until the caller collects the (one row per feature) result."""
    lng = feature_long(df, features, {"__y": col_(target).cast("double")})
    x = F.col("x")
    v = F.coalesce(x, F.lit(0.0)) if fill_zero else x
    agg = lng.groupBy("feature").agg(F.var_pop(v).alias("variance"),
                                     guarded_corr(x, F.col("__y")).alias("corr"))
    kept = agg.filter((F.col("variance") > F.lit(threshold)) & F.col("corr").isNotNull())
    key = F.round(F.abs("corr") * 1e12) / 1e12
    w = Window.orderBy(key.desc(), F.asc("feature"))  # one row per feature
    return kept.select("feature", F.abs("corr").alias("abs_corr"),
                       F.row_number().over(w).cast("long").alias("rank"))


def top_report(report: DataFrame, score_col: str, k: int = 10, name_col: str = "Feature") -> DataFrame:
    """K5: top-k of a small report table with a 1-based rank."""
    key = F.round(F.col(score_col) * 1e12) / 1e12
    w = Window.orderBy(key.desc(), F.asc(name_col))
    return report.filter(F.col(score_col).isNotNull()).withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def top_importances(imp: DataFrame, k: int = 20, group_cols=("target",)) -> DataFrame:
    """K7: mean importance per (group, feature) over ensemble members, then top k per group."""
    g = list(group_cols)
    mean = imp.groupBy(*g, "feature").agg(F.avg("importance").alias("importance"))
    w = Window.partitionBy(*g).orderBy(F.desc("importance"), F.asc("feature"))
    return mean.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def top_contributions(df: DataFrame, values: dict, k: int = 15, id_col: str = "player_id") -> DataFrame:
    """K8: the ``k`` largest |contribution| per player and target. ``values``
    is target → {feature: SQL of the contribution, a double}. All of a player's
    values lie in one row, so the rows of an Arrow batch are sorted as a matrix
    and only the heads come back: no shuffle, no long table of every
    contribution. NaN ranks below every number, NULL has no rank, equal sizes go
    by feature name."""
    targets, names = list(values), sorted({f for exprs in values.values() for f in exprs})
    items = [(t, f) for t in targets for f in sorted(values[t])]
    spans = [([1 + n for n, item in enumerate(items) if item[0] == t], [names.index(f) for f in sorted(values[t])]) for t in targets]

    def rank(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for t, (at, place) in enumerate(spans):
                if not at or not batch.num_rows:
                    continue
                x = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in at])
                null = np.column_stack([batch.column(i).is_null().to_numpy(zero_copy_only=False) for i in at])
                size = np.where(null, 2.0, np.where(np.isnan(x), 1.0, -np.abs(x)))
                order = np.argsort(size, axis=1, kind="stable")[:, :k]
                kept = ~np.take_along_axis(null, order, axis=1)
                row, place_in_row = np.nonzero(kept)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(np.full(len(row), t, dtype=np.int32)),
                     pa.array(np.asarray(place, dtype=np.int32)[order[kept]]),
                     pa.array(np.take_along_axis(x, order, axis=1)[kept], from_pandas=False), pa.array(place_in_row.astype(np.int64) + 1)],
                    names=["id", "t", "f", "value", "rank"])

    wide = df.selectExpr(f"{q(id_col)} AS id", *[f"CAST({values[t][f]} AS DOUBLE) AS v{n}" for n, (t, f) in enumerate(items)])
    schema = StructType([wide.schema["id"], StructField("t", IntegerType()), StructField("f", IntegerType()),
                         StructField("value", DoubleType()), StructField("rank", LongType())])

    def text(labels, place):
        return f"array({', '.join(lit(x) for x in labels)})[{place}]"
    return wide.mapInArrow(rank, schema).selectExpr(f"id AS {q(id_col)}", f"{text(targets, 't')} AS target",
                                                    f"{text(names, 'f')} AS feature", "value", "rank")


def page(df: DataFrame, order_by, where=None, limit: int = 20, offset: int = 0) -> DataFrame:
    """K9: sort/filter/paging of an interactive table."""
    if where is not None:
        df = df.filter(where)
    return df.orderBy(*order_by).offset(offset).limit(limit)


def melt(df: DataFrame, ids, values, var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide → long."""
    return df.unpivot(list(ids), list(values), var_name, value_name)
