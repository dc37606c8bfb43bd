"""Imputation and outlier treatment (I1–I4) as fit/transform pairs.

``fit`` runs one aggregate job and keeps a few numbers per column; ``transform``
is a single projection with literals (constant-folded, codegen friendly).
Fitted values can be written as a parquet parameter table (S7) so scoring uses
frozen training statistics instead of re-computing them on each batch (Q4).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from ..functions.sqltext import lit, q
from . import quantile as Q
from .profile import col_


@dataclass
class FillModel:
    """Replace NULL with a per-column value (``coalesce``)."""
    values: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        exprs = {c: F.expr(f"coalesce({q(c)}, {lit(v)})") for c, v in self.values.items()
                 if c in have and v is not None}
        return df.withColumns(exprs) if exprs else df

    def to_df(self, spark: SparkSession) -> DataFrame:
        schema = StructType([StructField("column", StringType()), StructField("value", StringType())])
        return spark.createDataFrame([(c, None if v is None else repr(v)) for c, v in self.values.items()], schema)

    def save(self, spark: SparkSession, path: str) -> None:
        self.to_df(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FillModel":
        import ast
        rows = spark.read.parquet(path).collect()
        return cls({r["column"]: None if r["value"] is None else ast.literal_eval(r["value"]) for r in rows})


class MedianImputer:
    """Exact median per column."""

    def __init__(self, cols, method: str = "exact"):
        self.cols = list(cols)
        self.method = method

    def fit(self, df: DataFrame) -> FillModel:
        return FillModel(Q.medians(df, self.cols, method=self.method))


class ModeImputer:
    """Most frequent value per column, ties → smallest (like
    ``SimpleImputer('most_frequent')``). Counts per (column, value), then the
    largest count per column: two aggregates, no join, no value map in one task."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> FillModel:
        types = {f.name: f.dataType for f in df.schema.fields}
        values = {}
        for kind in ("num", "str"):
            cols = [c for c in self.cols
                    if (isinstance(types[c], NumericType)) == (kind == "num")]
            if not cols:
                continue
            vt = "double" if kind == "num" else "string"
            structs = [F.struct(F.lit(c).alias("c"), col_(c).cast(vt).alias("v")) for c in cols]
            longf = df.select(F.explode(F.array(*structs)).alias("s")).select("s.*").filter(F.col("v").isNotNull())
            cnt = longf.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
            mode = cnt.groupBy("c").agg(F.min(F.struct(-F.col("n"), F.col("v"))).alias("b")).select("c", "b.v")
            for r in mode.collect():
                v = r["v"]
                if kind == "num" and isinstance(types[r["c"]], NumericType) and \
                        types[r["c"]].typeName() in ("integer", "long", "short", "byte") and v is not None:
                    v = int(v)
                values[r["c"]] = v
        return FillModel({c: values.get(c) for c in self.cols})


@dataclass
class OutlierModel:
    """I4: values strictly outside [Q1 − k·IQR, Q3 + k·IQR] become the median."""
    bounds: dict  # column -> (lo, hi, median)

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, (lo, hi, med) in self.bounds.items():
            if lo is None:
                continue
            x = q(c)
            exprs[c] = F.expr(f"CASE WHEN ({x} < {lit(lo)}) OR ({x} > {lit(hi)}) THEN {lit(med)} ELSE {x} END")
        return df.withColumns(exprs) if exprs else df

    def count_outliers(self, df: DataFrame) -> DataFrame:
        """One-row frame: outliers per column plus ``total``."""
        aggs = []
        for c, (lo, hi, _) in self.bounds.items():
            x = col_(c)
            cond = (x < F.lit(lo)) | (x > F.lit(hi)) if lo is not None else F.lit(False)
            aggs.append(F.count_if(cond).alias(c))
        one = df.agg(*aggs)
        total = sum(F.col(col_name) for col_name in [f"`{c}`" for c in self.bounds]) if self.bounds else F.lit(0)
        return one.withColumn("total", total)


class IQROutlierClipper:
    def __init__(self, cols, k: float = 1.5, method: str = "exact"):
        self.cols, self.k, self.method = list(cols), k, method

    def fit(self, df: DataFrame) -> OutlierModel:
        qs = Q.quantile_values(df, self.cols, [0.25, 0.5, 0.75], method=self.method)
        bounds = {}
        for c in self.cols:
            q1, med, q3 = qs[c]
            if q1 is None:
                bounds[c] = (None, None, None)
            else:
                iqr = q3 - q1
                bounds[c] = (q1 - self.k * iqr, q3 + self.k * iqr, med)
        return OutlierModel(bounds)
