"""Exact top-k search (operator 3): ball-tree branch and bound per shard.

Vectors are dealt to shards of bounded size by a hash of their id; each shard
builds a ball tree (halving along the direction of largest spread, so equal
vectors split by position). For a query q and a node with centre c and radius
r, no vector of the node scores above q.c + |q| r; nodes are opened in the
order of that bound and the search of a shard ends once the bound falls below
the query's current kth score. The kth score is shared: the first pass opens
only each query's best node in every shard, the k best scores over all shards
give a lower limit, and the second pass prunes with it from the start.

Queries are read in blocks of at most ``block`` rows; a block goes to every
task (its size is bounded by the parameter), the shards stay where they are.

Scores are exact integers. Defined cases: vectors that are null, hold null or
non-finite components or have a null id take no part; a vector is compared
with those of its own length only; rows that repeat an id count once (the
largest vector); fewer than k candidates give all of them; ties go to the
smaller id; scores outside 64 bits are clipped to them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, v): floor(scale * x) of every component, one row per id."""
    x = f"transform(`{vector_col}`, x -> CAST(x AS DOUBLE))"
    usable = f"`{id_col}` IS NOT NULL AND `{vector_col}` IS NOT NULL AND forall({x}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = vectors.filter(usable).select(
        F.col(id_col).cast("long").alias("id"),
        F.expr(f"transform({x}, x -> floor({int(scale)} * x))").alias("v"))
    rows = rows.withColumn("dim", F.size("v"))
    return rows.groupBy("id").agg(F.max(F.struct("dim", "v")).alias("r")).select("id", "r.dim", "r.v")


class BallTree:
    """Leaves of at most ``leaf`` rows; nodes in arrays, children 2i+1 and 2i+2."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = 64):
        self.v, self.ids = vectors, ids
        levels = max(0, int(np.ceil(np.log2(max(1, len(ids)) / leaf))))
        self.n_inner = 2 ** levels - 1
        order = np.arange(len(ids))
        self.members = {0: order}
        n_nodes = 2 ** (levels + 1) - 1
        dim = vectors.shape[1]
        self.centre, self.radius = np.zeros((n_nodes, dim)), np.zeros(n_nodes)
        for node in range(n_nodes):
            rows = self.members[node]
            x = vectors[rows]
            if len(rows):
                self.centre[node] = x.mean(axis=0)
                self.radius[node] = np.sqrt(((x - self.centre[node]) ** 2).sum(axis=1).max())
            if node < self.n_inner:
                if len(rows):
                    rows = rows[np.argsort(x[:, np.argmax(np.ptp(x, axis=0))], kind="stable")]
                half = len(rows) // 2
                self.members[2 * node + 1], self.members[2 * node + 2] = rows[:half], rows[half:]
                del self.members[node]

    def bounds(self, node: int, q: np.ndarray, norm: np.ndarray) -> np.ndarray:
        b = q @ self.centre[node] + norm * self.radius[node]
        return b + 1e-9 * (np.abs(b) + norm) + 1e-6  # rounding never prunes a true hit


def exact_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products as exact 64-bit integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if most < 2 ** 53:
        return (q @ v.T).astype(np.int64)
    whole = np.array(q.astype(object)).dot(v.T.astype(object)) if most >= 2 ** 62 else q.astype(np.int64) @ v.T.astype(np.int64)
    if most >= 2 ** 62:
        low, high = -2 ** 63, 2 ** 63 - 1
        whole = np.array([[min(max(int(x), low), high) for x in r] for r in whole], dtype=np.int64).reshape(len(q), len(v))
    return whole


def keep_best(best, rows, ids, scores, own, k):
    """Merge (ids, scores) of some queries into their running best k, ordered
    by score, then smaller id."""
    for i, r in enumerate(rows):
        ok = ids != own[r]
        s = np.concatenate([best[r][0], scores[i][ok]])
        d = np.concatenate([best[r][1], ids[ok]])
        top = np.lexsort((d, -s))[:k]
        best[r] = (s[top], d[top])


def search(tree: BallTree, q: np.ndarray, own: np.ndarray, k: int, limit: np.ndarray, first_only: bool):
    """Best k of this shard per query, given a lower limit of the kth score."""
    norm = np.sqrt((q.astype(float) ** 2).sum(axis=1))
    best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in q]
    kth = limit.astype(float)
    if first_only:  # the leaf with the best bound
        leaves = [n for n in tree.members if len(tree.members[n])]
        choice = np.argmax(np.stack([tree.bounds(n, q, norm) for n in leaves], axis=1), axis=1)
        for c in np.unique(choice):
            rows, m = np.flatnonzero(choice == c), tree.members[leaves[c]]
            keep_best(best, rows, tree.ids[m], exact_scores(q[rows], tree.v[m]), own, k)
        return best
    # open nodes best first: all queries share the walk, each with its own bound
    import heapq

    all_q = np.arange(len(q))
    b = tree.bounds(0, q, norm)
    heap = [(-float((b - kth).max(initial=-np.inf)), 0, all_q, b)] if len(q) else []
    while heap:
        _, node, rows, b = heapq.heappop(heap)
        alive = b >= kth[rows]
        rows = rows[alive]
        if not len(rows):
            continue
        if node >= tree.n_inner:
            m = tree.members[node]
            if len(m):
                keep_best(best, rows, tree.ids[m], exact_scores(q[rows], tree.v[m]), own, k)
                for r in rows:
                    if len(best[r][0]) == k:
                        kth[r] = max(kth[r], best[r][0][-1])
            continue
        for child in (2 * node + 1, 2 * node + 2):
            cb = tree.bounds(child, q[rows], norm[rows])
            ok = cb >= kth[rows]
            if ok.any():
                heapq.heappush(heap, (-float((cb[ok] - kth[rows][ok]).max()), child, rows[ok], cb[ok]))
    return best


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 1024, shard_rows: int = 4096, block: int = 4096) -> DataFrame:
    """Rows (query_id, rank from 1, vec_id, score): the k best other rows of
    every row whose id is divisible by ``every``."""
    from functools import reduce

    spark = vectors.sparkSession
    ship(spark)
    rows = quantised(vectors, id_col, vector_col, scale)
    rows = stored(rows, "vectors")
    n = rows.count()
    shards = max(1, -(-n // shard_rows))
    rows = rows.withColumn("shard", F.expr(f"CAST(pmod(xxhash64(id), {shards}) AS INT)"))
    # one row per shard and vector length, built once: later passes reread it
    packed = stored(rows.groupBy("shard", "dim").applyInPandas(
        _pack, "shard int, dim int, ids binary, vecs binary"), "shards")

    asked = rows.filter(f"pmod(id, {int(every)}) = 0").select("id", "dim", "v")
    blocks = max(1, -(-asked.count() // block))
    asked = asked.withColumn("block", F.expr(f"CAST(pmod(xxhash64(id, 1), {blocks}) AS INT)"))
    found = []
    for b in range(blocks):
        own = asked.filter(F.col("block") == b).toPandas()
        by_dim = {int(d): (g["id"].to_numpy(np.int64), np.array(g["v"].tolist(), dtype=float).reshape(len(g), int(d)))
                  for d, g in own.groupby("dim")}
        sent = spark.sparkContext.broadcast((by_dim, {}))
        first = packed.mapInPandas(_searcher(sent, k, True), RESULT)
        limit = {int(r["query_id"]): int(r["s"]) for r in (
            first.groupBy("query_id").agg(F.expr(f"slice(sort_array(collect_list(score), false), 1, {k})").alias("s"))
            .filter(F.size("s") == k).select("query_id", F.element_at("s", k).alias("s")).collect())}
        found.append(packed.mapInPandas(_searcher(spark.sparkContext.broadcast((by_dim, limit)), k, False), RESULT))
    hits = reduce(DataFrame.unionByName, found)
    # at most k rows per query and shard arrive here
    best = hits.groupBy("query_id").agg(F.expr(
        f"slice(array_sort(collect_list(struct(-CAST(score AS DECIMAL(20, 0)) AS neg, vec_id, score))), 1, {k})").alias("b"))
    return best.select("query_id", F.posexplode("b").alias("p", "h")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("h.vec_id").alias("vec_id"), F.col("h.score").alias("score"))


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = pdf["id"].to_numpy(np.int64)
    v = np.array(pdf["v"].tolist(), dtype=np.int64).reshape(len(ids), -1)
    return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "dim": [pdf["dim"].iloc[0]],
                         "ids": [ids.tobytes()], "vecs": [v.astype(float).tobytes()]})


def _searcher(sent, k: int, first_only: bool):
    def run(frames):
        by_dim, limit = sent.value
        for pdf in frames:
            for dim, ids, vecs in zip(pdf["dim"], pdf["ids"], pdf["vecs"]):
                if int(dim) not in by_dim:
                    continue
                own, q = by_dim[int(dim)]
                ids = np.frombuffer(ids, np.int64)
                tree = BallTree(np.frombuffer(vecs, float).reshape(len(ids), int(dim)), ids)
                low = np.array([limit.get(int(i), -2 ** 63) for i in own], dtype=float)
                best = search(tree, q, own, k, low, first_only)
                yield pd.DataFrame({
                    "query_id": np.repeat(own, [len(s) for s, _ in best]),
                    "vec_id": np.concatenate([d for _, d in best] or [np.empty(0, np.int64)]),
                    "score": np.concatenate([s for s, _ in best] or [np.empty(0, np.int64)])})

    return run
