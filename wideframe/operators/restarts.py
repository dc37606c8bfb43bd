"""k-means with restarts (C1): Lloyd iterations of all starts at once.

One pass per iteration serves every start that still moves: each task adds up
counts, sums and inertia per (start, centre) over its Arrow batches, one row per
(start, centre) and task is shuffled and summed, and only the centres reach the
driver. The first centres are drawn by weighted k-means++ sampling in one pass
per centre for all starts together: a row's priority is log(u) / d², u a hash of
its values and the start, d its distance to the nearest centre so far, so draws
repeat on any cluster. The start with the lowest inertia is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .histboost import mix, uniform
from .profile import col_


@dataclass
class Start:
    centres: np.ndarray
    inertia: float = float("inf")
    iterations: int = 0
    moving: bool = True


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]).T if batch.num_rows else np.empty((0, batch.num_columns))
    if np.isnan(x).any():
        raise ValueError("a clustered column holds a missing value; impute it first")
    return x


def row_keys(x: np.ndarray) -> np.ndarray:
    """A 64-bit key per row of values."""
    key = np.full(len(x), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for j in range(x.shape[1]):
        key = mix(key ^ np.ascontiguousarray(x[:, j] + 0.0).view(np.uint64))
    return key


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centre, squared distance) of every row; ties go to the smaller number.
    Distances add up column by column, each one contiguous in a batch."""
    at, least = np.zeros(len(x), dtype=np.int64), None
    for k, c in enumerate(centres):
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            gap = x[:, j] - c[j]
            gap *= gap
            d += gap
        if least is None:
            least = d
        else:
            closer = d < least
            at[closer] = k
            least = np.minimum(d, least)
    return at, least


def _next_centres(rows: DataFrame, starts: list[np.ndarray], seed: int) -> list[np.ndarray | None]:
    """One more centre per start, drawn with probability in proportion to the
    squared distance (first centre: evenly)."""

    def run(batches):
        best: list = [None] * len(starts)
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            key = row_keys(x)
            for s, centres in enumerate(starts):
                d = nearest(x, centres)[1] if len(centres) else np.ones(len(x))
                u = uniform(key, seed + s, len(centres))
                p = np.divide(np.log(u), d, out=np.full(len(x), -np.inf), where=d > 0)
                i = int(np.lexsort((key, -p))[0])
                told = (float(p[i]), *x[i].tolist())
                best[s] = told if best[s] is None else max(best[s], told)
        found = [(s, *b) for s, b in enumerate(best) if b is not None and np.isfinite(b[0])]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.float64()),
                                          pa.array([list(f[2:]) for f in found], pa.list_(pa.float64()))], names=["start", "p", "x"])

    drawn = rows.mapInArrow(run, "start int, p double, x array<double>").groupBy("start").agg(F.max(F.struct("p", "x")).alias("b"))
    got = {r["start"]: np.array(r["b"]["x"]) for r in drawn.collect()}
    return [got.get(s) for s in range(len(starts))]


def _step(rows: DataFrame, starts: list[Start], which: list[int]) -> dict:
    """{start: (counts, sums, inertia)} of one assignment of all rows."""
    centres = {s: starts[s].centres for s in which}

    def run(batches):
        total = {s: np.zeros((len(c), 2 + c.shape[1])) for s, c in centres.items()}
        for batch in batches:
            x = _matrix(batch)
            for s, c in centres.items():
                at, d = nearest(x, c) if len(x) else (np.empty(0, int), np.empty(0))
                mine = (at == np.arange(len(c))[:, None]).astype(float)
                total[s][:, 0] += mine.sum(axis=1)
                total[s][:, 1] += mine @ d if len(x) else 0
                total[s][:, 2:] += mine @ x
        told = [(s, k, row.tolist()) for s, t in total.items() for k, row in enumerate(t)]
        yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in told], pa.int32()), pa.array([t[1] for t in told], pa.int32()),
                                          pa.array([t[2] for t in told], pa.list_(pa.float64()))], names=["start", "centre", "v"])

    width = 2 + len(rows.columns)
    summed = rows.mapInArrow(run, "start int, centre int, v array<double>").groupBy("start", "centre").agg(
        *[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(width)])
    out: dict = {}
    for r in summed.collect():
        t = out.setdefault(r["start"], np.zeros((len(centres[r["start"]]), width)))
        t[r["centre"]] = [r[f"v{j}"] for j in range(width)]
    return {s: (t[:, 0], t[:, 2:], float(t[:, 1].sum())) for s, t in out.items()}


def fit_restarts(df: DataFrame, cols, k: int = 2, starts: int = 10, seed: int = 42, iterations: int = 300, tolerance: float = 1e-4) -> list[Start]:
    """All starts, the best one first (lowest inertia, then smallest number).
    A start stops when its centres move by at most ``tolerance`` times the mean
    variance of the columns, or hold still. Fewer distinct rows than ``k`` give
    fewer centres; an empty centre stays where it was; no rows give no starts."""
    rows = df.select(*[col_(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    spread = rows.agg(*[F.var_pop(c).alias(c) for c in rows.columns]).first()
    if any(v is None for v in spread):
        return []
    limit = tolerance * float(np.mean([float(v) for v in spread]))
    chosen = [np.empty((0, len(rows.columns))) for _ in range(starts)]
    for _ in range(k):
        chosen = [c if x is None else np.vstack([c, x]) for c, x in zip(chosen, _next_centres(rows, chosen, seed))]
    out = [Start(c) for c in chosen]
    for _ in range(iterations):
        which = [s for s, x in enumerate(out) if x.moving]
        if not which:
            break
        for s, (count, total, inertia) in _step(rows, out, which).items():
            new = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], out[s].centres)
            out[s].moving = bool(((new - out[s].centres) ** 2).sum() > limit)
            out[s].centres, out[s].inertia, out[s].iterations = new, inertia, out[s].iterations + 1
    for s, (_, _, inertia) in _step(rows, out, list(range(starts))).items():  # of the centres as they are now
        out[s].inertia = inertia
    return [out[s] for s in sorted(range(starts), key=lambda s: (out[s].inertia, s))]
