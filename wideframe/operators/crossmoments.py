"""Correlations of thousands of columns in one scan.

The pairwise-complete moments of all pairs of columns are matrix products over
an Arrow batch: with X the centred values (missing: 0) and M the presence mask,
M'M counts the rows that two columns share, X'M and (X∘X)'M are sums and squares
over those rows, X'X the cross products. Each task adds up its batches and sends
square tiles; tiles with the same place are summed where they meet and come out
as rows (row_feature, col_feature, corr), so nothing of the size of the matrix
reaches the driver. Columns are centred at their means first, against
cancellation.

Memory: a task holds four k × k matrices of the columns of one strip; strips are
cut so that they stay below ``cells`` numbers, and each strip is one scan (2 000
columns: one). A constant or empty side gives null, as an infinite value does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import col_, wide_agg


def _moments(rows: DataFrame, k: int, left: range, tile: int) -> DataFrame:
    """(i, j, sums) tiles of the products of the columns ``left`` with all."""

    def run(batches):
        low, high = left.start, left.stop
        total = np.zeros((6, high - low, k))
        seen = False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            m = (~np.isnan(x)).astype(float)
            x = np.where(m > 0, x, 0.0)
            a, ma, s = x[:, low:high], m[:, low:high], x * x
            for t, (u, v) in enumerate(((ma, m), (a, m), (ma, x), (s[:, low:high], m), (ma, s), (a, x))):
                total[t] += u.T @ v
        if seen:
            at = [(i, j) for i in range(0, high - low, tile) for j in range(0, k, tile)]
            for i, j in at:
                part = np.ascontiguousarray(total[:, i:i + tile, j:j + tile])
                yield pa.RecordBatch.from_arrays([pa.array([low + i], pa.int32()), pa.array([j], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                                                 names=["i", "j", "sums"])

    return rows.mapInArrow(run, "i int, j int, sums binary")


def corr_tiles(df: DataFrame, cols, tile: int = 256, cells: int = 50_000_000) -> DataFrame:
    """(row_feature, col_feature, corr) of all ordered pairs of ``cols``."""
    cols = list(cols)
    k = len(cols)
    if len(set(cols)) < k:
        raise ValueError("columns repeat")
    named = df.select(*[col_(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    value = [F.when(~F.isnan(c), F.col(c)) for c in named.columns]
    means = wide_agg(named, [F.avg(v).alias(c) for c, v in zip(named.columns, value)]).first() if k else {}
    rows = named.select(*[(v - F.lit(float(means[c]) if means[c] is not None and np.isfinite(means[c]) else 0.0)).alias(c)
                          for c, v in zip(named.columns, value)])
    height = max(tile, cells // (6 * max(k, 1)) // tile * tile)
    parts = [_moments(rows, k, range(a, min(a + height, k)), tile) for a in range(0, k, height)]
    tiles = parts[0] if parts else df.sparkSession.createDataFrame([], "i int, j int, sums binary")
    for p in parts[1:]:
        tiles = tiles.union(p)

    def finish(batches):
        total: dict = {}
        for batch in batches:
            for i, j, v in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(v, float)
                total[i, j] = total[i, j] + x if (i, j) in total else x
        for (i, j), x in total.items():
            h, w = min(tile, k - i), min(tile, k - j)
            n, sx, sy, xx, yy, xy = x.reshape(6, h, w)
            with np.errstate(divide="ignore", invalid="ignore"):
                vx, vy = xx - sx * sx / n, yy - sy * sy / n
                r = (xy - sx * sy / n) / np.sqrt(vx * vy)
            # what is left of a constant column after centring is rounding
            flat = (vx <= 1e-12 * np.maximum(xx, 1e-300)) | (vy <= 1e-12 * np.maximum(yy, 1e-300))
            r = np.where(flat | ~np.isfinite(r), np.nan, r)
            names = np.array(cols, dtype=object)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(names[i:i + h], w), pa.string()), pa.array(np.tile(names[j:j + w], h), pa.string()),
                 pa.array(r.ravel(), mask=np.isnan(r.ravel()))], names=["row_feature", "col_feature", "corr"])

    return tiles.repartition("i", "j").mapInArrow(finish, "row_feature string, col_feature string, corr double")
