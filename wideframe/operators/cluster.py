"""Clustering profiles (C1–C6): KMeans, PCA, silhouette, naming, report."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .profile import col_

# The two profile names.
NAME_HIGH = "Perfil A (Alto Desempenho)"
NAME_MODERATE = "Perfil B (Desempenho Moderado)"


def assign_nearest(df: DataFrame, cols, centroids: dict, out: str = "cluster") -> DataFrame:
    """C2 for fixed centroids: argmin squared distance, ties → smallest id."""
    ids = sorted(centroids)
    dist = {k: sum((col_(c) - F.lit(float(v))) ** 2 for c, v in zip(cols, centroids[k])) for k in ids}
    tmp = {f"__d{k}": d for k, d in dist.items()}
    df = df.withColumns(tmp)
    best = F.least(*[F.col(n) for n in tmp]) if len(tmp) > 1 else F.col(next(iter(tmp)))
    expr = None
    for k in reversed(ids):
        expr = F.when(F.col(f"__d{k}") == best, F.lit(k)) if expr is None else \
            F.when(F.col(f"__d{k}") == best, F.lit(k)).otherwise(expr)
    return df.withColumn(out, expr.cast("int")).drop(*tmp)


def project(df: DataFrame, cols, loadings, prefix: str = "pc") -> DataFrame:
    """C3 for fixed loadings: one dot product per component."""
    return df.withColumns({f"{prefix}{j + 1}": sum(F.lit(float(w)) * col_(c) for c, w in zip(cols, comp))
                           for j, comp in enumerate(loadings)})


@dataclass
class ClusterModel:
    """C2/C3/C5/C6 as saved state: trained columns, scaler, centroids,
    loadings and (frozen) profile names."""
    columns: list
    scaler: object
    centroids: dict
    loadings: tuple = ()
    names: dict = field(default_factory=dict)

    def transform(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        z = self.scaler.transform(df)
        z = assign_nearest(z, self.columns, self.centroids, out)
        return project(z, self.columns, self.loadings) if self.loadings else z


def fit_kmeans(df: DataFrame, cols, k: int = 2, seed: int = 42):
    """MLlib KMeans (k-means||) on already standardized columns without NULLs."""
    va = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="error")
    model = KMeans(k=k, seed=seed, featuresCol="__features", predictionCol="cluster").fit(va.transform(df))
    return va, model


def kmeans_assign(df: DataFrame, va, model) -> DataFrame:
    return model.transform(va.transform(df)).drop("__features")


def fit_pca(df: DataFrame, cols, k: int = 2):
    """C3 fit: MLlib PCA does not centre at transform, so input must already be
    standardized (Z1). Component signs are arbitrary; each is flipped so that
    its largest-magnitude loading is positive."""
    va = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="keep")
    model = PCA(k=k, inputCol="__features", outputCol="__pca").fit(va.transform(df))
    pc = np.array(model.pc.toArray(), copy=True)  # (n_features, k)
    for j in range(pc.shape[1]):
        if pc[np.argmax(np.abs(pc[:, j])), j] < 0:
            pc[:, j] = -pc[:, j]
    loadings = [tuple(float(x) for x in pc[:, j]) for j in range(pc.shape[1])]
    return loadings, [float(x) for x in model.explainedVariance.toArray()]


def silhouette(df: DataFrame, cols, cluster_col: str = "cluster", distance: str = "squaredEuclidean") -> float:
    """C4: MLlib's distributed silhouette (squared Euclidean by default) over
    the rows that the fit saw; a NULL feature is an error (impute first)."""
    va = VectorAssembler(inputCols=list(cols), outputCol="__features", handleInvalid="error")
    ev = ClusteringEvaluator(featuresCol="__features", predictionCol=cluster_col,
                             metricName="silhouette", distanceMeasure=distance)
    return ev.evaluate(va.transform(df.withColumn(cluster_col, F.col(cluster_col).cast("double"))))


def name_clusters(df: DataFrame, cluster_col: str, score_col: str) -> DataFrame:
    """The cluster with the higher mean score is profile A (a tie goes
    to the higher label). Works on the per-cluster aggregate (k rows)."""
    means = df.groupBy(cluster_col).agg(F.avg(score_col).alias("mean_score"))
    w = Window.orderBy(F.desc("mean_score"), F.desc(cluster_col))  # k rows only
    return means.withColumn("name", F.when(F.row_number().over(w) == 1, F.lit(NAME_HIGH))
                            .otherwise(F.lit(NAME_MODERATE)))


def cluster_report(df: DataFrame, cluster_col: str, score_col: str, pred_cols,
                   names: DataFrame | None = None) -> DataFrame:
    """A17/A18/L9 (+C5): count, percentage, share, mean score and prediction
    means per cluster. The total comes from a window over the k-row aggregate.

    Without ``names`` the profile names are derived from the same aggregate
    (the mean score is already there, so C5 needs no second grouping of the
    rows and no join); given names (e.g. frozen at training) are joined to the
    k-row result."""
    agg = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("count"),
                                      F.avg(score_col).alias("P_mean"),
                                      *[F.avg(p).alias(f"mean_{p}") for p in pred_cols])
    total = F.sum("count").over(Window.partitionBy())
    out = agg.withColumn("percentage", F.col("count") * 100.0 / total).withColumn("share", F.col("count") / total)
    if names is None:
        w = Window.orderBy(F.desc("P_mean"), F.desc(cluster_col))  # k rows only, as name_clusters
        out = out.withColumn("name", F.when(F.row_number().over(w) == 1, F.lit(NAME_HIGH))
                             .otherwise(F.lit(NAME_MODERATE)))
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ["P_mean"] + [f"mean_{p}" for p in pred_cols]})
    if names is None:
        return out.select(cluster_col, *[c for c in out.columns if c != cluster_col])
    return out.join(F.broadcast(names), cluster_col, "left")
