"""Additive contributions.

* Linear models: ``coef·(x − mean(x))`` — an exact column expression.
* Tree models (MLlib decision tree, random forest, gradient-boosted trees):
  path-dependent TreeSHAP (Lundberg et al., 2018). The tree structure is read
  from the model's saved node table (model-sized, so bounded), the contribution
  of every leaf is computed for a whole Arrow batch at once in
  ``mapInPandas`` — Spark partitions the rows, NumPy does the arithmetic.

For a leaf reached through unique features P with cover fractions z_j and
indicators o_j (x follows the path at every split on j), feature i receives
    v · (o_i − z_i) · Σ_k k!(|P|−k−1)!/|P|! · e_k,
where e_k is the t^k coefficient of Π_{j≠i}(z_j + o_j·t). The product over all
of P is built once per leaf and the factor of i is divided out. The o_j are bits,
so a leaf's contributions are tabulated for all patterns once, and a row looks
its pattern up.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .profile import col_


@dataclass
class Tree:
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    weight: float = 1.0


def _node_rows_to_tree(rows, weight: float) -> Tree:
    rows = sorted(rows, key=lambda r: r["id"])
    n = len(rows)
    ids = {r["id"]: i for i, r in enumerate(rows)}
    t = Tree(np.full(n, -1), np.full(n, -1), np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n), weight)
    for i, r in enumerate(rows):
        t.value[i] = r["prediction"]
        stats = r["impurityStats"]
        t.cover[i] = float(stats[0]) if stats else float(r["rawCount"])
        if r["leftChild"] >= 0:
            t.left[i] = ids[r["leftChild"]]
            t.right[i] = ids[r["rightChild"]]
            t.feature[i] = r["split"]["featureIndex"]
            t.threshold[i] = r["split"]["leftCategoriesOrThreshold"][0]
    return t


def trees_from_model(model, spark) -> list[Tree]:
    """Read an MLlib regression tree / forest / GBT through its saved node table.

    The model is written under the shared checkpoint folder; only the node
    rows (model-sized) are read back.
    """
    from ..session import scratch_path

    path = scratch_path(spark, f"tree-model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "treeID" in data.columns:
        from pyspark.ml.regression import RandomForestRegressionModel
        weights = list(model.treeWeights)
        if isinstance(model, RandomForestRegressionModel):   # a forest averages its trees
            weights = [w / len(weights) for w in weights]
        by_tree: dict[int, list] = {}
        for r in data.select("treeID", "nodeData.*").collect():
            by_tree.setdefault(r["treeID"], []).append(r)
        return [_node_rows_to_tree(by_tree[i], weights[i]) for i in sorted(by_tree)]
    return [_node_rows_to_tree(data.collect(), 1.0)]


def _leaf_paths(tree: Tree):
    """(value, [(feature, threshold, goes_left, zero_fraction)…]) per leaf."""
    out = []
    stack = [(0, [])]
    while stack:
        node, path = stack.pop()
        if tree.left[node] < 0:
            out.append((tree.value[node], path))
            continue
        f, thr, c = tree.feature[node], tree.threshold[node], tree.cover[node]
        for child, left in ((tree.left[node], True), (tree.right[node], False)):
            z = tree.cover[child] / c if c > 0 else 0.0
            stack.append((child, path + [(int(f), float(thr), left, z)]))
    return out


def expected_value(trees: list[Tree]) -> float:
    total = 0.0
    for t in trees:
        ev = 0.0
        for v, path in _leaf_paths(t):
            ev += v * math.prod(z for *_, z in path)
        total += t.weight * ev
    return total


def _weights(p: int) -> np.ndarray:
    return np.array([math.factorial(k) * math.factorial(p - k - 1) / math.factorial(p) for k in range(p)])


def _contributions(z: np.ndarray, o: list) -> np.ndarray:
    """Contribution of each of a leaf's features per unit of leaf value, for
    rows given by their indicators ``o`` (one array per feature)."""
    p, n = len(z), len(o[0])
    # coefficients of Π_j (z_j + o_j t), each an array over rows
    coef = [np.ones(n)]
    for j in range(p):
        nxt = [np.zeros(n) for _ in range(len(coef) + 1)]
        for k, ck in enumerate(coef):
            nxt[k] = nxt[k] + ck * z[j]
            nxt[k + 1] = nxt[k + 1] + ck * o[j]
        coef = nxt
    w, out = _weights(p), np.empty((n, p))
    for i in range(p):
        zi, oi = z[i], o[i]
        # divide out (z_i + o_i t): o_i = 0 → /z_i ; o_i = 1 → synthetic division
        q0 = [c / zi for c in coef[:p]] if zi > 0 else [np.zeros(n)] * p
        q1 = [None] * p
        q1[p - 1] = coef[p]
        for k in range(p - 1, 0, -1):
            q1[k - 1] = coef[k] - zi * q1[k]
        s0 = sum(w[k] * q0[k] for k in range(p))
        s1 = sum(w[k] * q1[k] for k in range(p))
        out[:, i] = (oi - zi) * np.where(oi > 0, s1, s0)
    return out


#: Leaves of at most so many unique features get a table of all indicator patterns.
TABLE_FEATURES = 10


@dataclass
class Leaf:
    """A leaf for scoring: its unique features, the splits on each, and (few
    features) the contributions for every pattern of indicators."""
    value: float
    features: list
    splits: list          # per feature: [(threshold, goes left)…]
    zeros: np.ndarray
    table: np.ndarray | None  # per feature, by pattern


def leaves_of(tree: Tree) -> list[Leaf]:
    out = []
    for v, path in _leaf_paths(tree):
        by: dict[int, list] = {}
        for f, thr, left, z in path:
            e = by.setdefault(f, [1.0, []])
            e[0] *= z
            e[1].append((thr, left))
        if not by:
            continue
        z = np.array([e[0] for e in by.values()])
        p, table = len(z), None
        if p <= TABLE_FEATURES:
            bits = (np.arange(1 << p)[:, None] >> np.arange(p)) & 1
            table = np.ascontiguousarray((tree.weight * v * _contributions(z, [bits[:, j].astype(float) for j in range(p)])).T)
        out.append(Leaf(tree.weight * v, list(by), [e[1] for e in by.values()], z, table))
    return out


def tree_shap(X: np.ndarray, trees: list[Tree], leaves: list | None = None) -> np.ndarray:
    """Path-dependent SHAP values, shape (rows, features). A row's indicators on
    a leaf's features number a row of the leaf's table. ``leaves`` are the trees'
    ``leaves_of``, for callers that score many batches. A missing value follows
    neither side of a split."""
    columns, phi = np.ascontiguousarray(X.T), np.zeros(X.shape[::-1])  # one contiguous row per feature
    for mine in leaves or map(leaves_of, trees):
        sides: dict = {}

        def follows(f, split):
            if (f, split) not in sides:
                thr, left = split
                sides[f, split] = columns[f] <= thr if left else columns[f] > thr
            return sides[f, split]

        for leaf in mine:
            o = []
            for f, splits in zip(leaf.features, leaf.splits):
                go = follows(f, splits[0])
                for split in splits[1:]:
                    go = go & follows(f, split)
                o.append(go)
            if leaf.table is None:
                phi[leaf.features] += leaf.value * _contributions(leaf.zeros, [x.astype(float) for x in o]).T
                continue
            at = o[0].astype(np.uint16)
            for j, x in enumerate(o[1:], 1):
                at |= np.multiply(x, np.uint16(1 << j), dtype=np.uint16)
            at = at.astype(np.intp)
            for f, told in zip(leaf.features, leaf.table):
                phi[f] += told.take(at)
    return phi.T


def tree_contributions(df: DataFrame, trees: list[Tree], features, id_col: str, target: str,
                       top_k: int | None = None) -> DataFrame:
    """Long (id, target, feature, value[, rank]) for a tree model via ``mapInPandas``.

    The tree arrays are broadcast once (model-sized) and their leaves are
    tabulated once per task; rows are processed one Arrow batch at a time. With ``top_k`` the K8 report (largest
    |contribution| per player, ties by feature name) is taken inside the task:
    all of a player's contributions are produced together, so no window and
    no shuffle are needed.
    """
    features = list(features)
    fields = [StructField(id_col, df.schema[id_col].dataType), StructField("target", StringType()),
              StructField("feature", StringType()), StructField("value", DoubleType())]
    if top_k is not None:
        from pyspark.sql.types import LongType
        fields.append(StructField("rank", LongType()))
    schema = StructType(fields)
    names = np.array(features, dtype=object)
    name_order = np.argsort(np.argsort(names))          # rank of each feature name

    sent = df.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        leaves = [leaves_of(t) for t in sent.value]
        for pdf in batches:
            if pdf.empty:
                continue
            X = pdf[features].to_numpy(dtype=float, na_value=np.nan)
            phi = tree_shap(X, sent.value, leaves)
            n, m = phi.shape
            ids = pdf[id_col].to_numpy()
            if top_k is None:
                yield pd.DataFrame({id_col: np.repeat(ids, m), "target": target,
                                    "feature": np.tile(names, n), "value": phi.reshape(-1)})
                continue
            k = min(top_k, m)
            # order each row by (-|value|, feature name)
            order = np.lexsort((np.broadcast_to(name_order, phi.shape), -np.abs(phi)), axis=1)[:, :k]
            rows = np.repeat(np.arange(n), k)
            cols = order.reshape(-1)
            yield pd.DataFrame({id_col: ids[rows], "target": target, "feature": names[cols],
                                "value": phi[rows, cols], "rank": np.tile(np.arange(1, k + 1), n)})

    return df.select(id_col, *[col_(c).cast("double").alias(c) for c in features]).mapInPandas(run, schema)
