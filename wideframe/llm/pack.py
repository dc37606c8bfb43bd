"""Packing (operator 8): mixture-controlled packing by deficit round-robin.

Each source is a queue: its documents' ids in one stream, cut into units of
``quantum`` ids. A source earns credit in proportion to its target share with
every id that is sent, and the source with the largest deficit (credit minus
ids sent, in units) sends its next unit. In virtual time that is the order of
the due times ``(2k + 1) / (2 w)`` of unit ``k`` of a source of weight ``w``,
so the place of any unit follows from the sources' totals alone: count, for
every source, the units that are due before. The arithmetic is exact (integer),
places are gapless, and deficits carry over windows and partitions because
nothing is reset at either. When a queue runs dry the others go on in
proportion.

The order of units is cut into sequences of ``seq_len`` ids; all but the last
are full. Scale: documents are tokenised once into a stored table; per-task
totals place each document in its queue; only one row per source reaches the
driver, and ids never move between tasks.

Defined cases: null or empty text is one end id; a null source is a source;
repeated rows are packed once each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_join, stored
from .tokens import EOS, VOCABULARY, tokenised

WEIGHT_SCALE = 1 << 16


def queue_table(totals: dict, quantum: int, weights: dict | None = None):
    """(names, weight, units, ids in the last unit) of the non-empty queues.
    Weights are integers; without target weights a queue's share is its own
    share of all units, so all queues end together."""
    names = sorted(g for g, n in totals.items() if n)
    n = np.array([totals[g] for g in names], dtype=np.int64)
    units = -(-n // quantum)
    share = np.array([float(weights.get(g, 0)) for g in names]) if weights else units.astype(float)
    w = np.maximum(1, np.rint(share / max(share.sum(), 1e-300) * WEIGHT_SCALE)).astype(np.int64)
    return names, w, units, n - (units - 1) * quantum


def unit_places(queue: np.ndarray, k: np.ndarray, w, units, last, quantum: int) -> np.ndarray:
    """Global position of the first id of unit ``k`` of ``queue`` (arrays)."""
    own = w[queue]
    place = np.zeros(len(k), dtype=np.int64)
    for s in range(len(w)):
        ahead = (2 * k + 1) * w[s] - own
        # units due earlier; on equal due times the queue with the smaller number goes first
        before = np.where(s < queue, ahead // (2 * own) + 1, -(-ahead // (2 * own)))
        before = np.where(queue == s, k, np.clip(before, 0, units[s]))
        place += before * quantum - np.where(before == units[s], quantum - last[s], 0)
    return place


def cut(ids: list[bytes], queue: np.ndarray, start: np.ndarray, n: np.ndarray, table, quantum: int, seq_len: int):
    """Pieces of a batch of documents: (row, start in document, length,
    sequence, offset). Neighbouring units of a document that follow each other
    in the same sequence are one piece."""
    _, w, units, last = table
    first, final = start // quantum, (start + n - 1) // quantum
    count = final - first + 1
    row = np.repeat(np.arange(len(ids)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
    low = np.maximum(k * quantum, start[row])
    high = np.minimum((k + 1) * quantum, (start + n)[row])
    pos = unit_places(queue[row], k, w, units, last, quantum) + low - k * quantum
    low, length = low - start[row], high - low
    # a unit that lies across two sequences becomes two pieces
    head = np.minimum(length, seq_len - pos % seq_len)
    over = head < length
    row, low, length, pos = (np.concatenate(x) for x in (
        (row, row[over]), (low, (low + head)[over]), (head, (length - head)[over]), (pos, (pos + head)[over])))
    order = np.lexsort((low, row))
    row, low, length, pos = row[order], low[order], length[order], pos[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + length[:-1]) | (pos[1:] % seq_len == 0)
    at = np.flatnonzero(new)
    return row[at], low[at], np.add.reduceat(length, at), pos[at] // seq_len, pos[at] % seq_len


def pack(docs: DataFrame, seq_len: int = 2048, quantum: int = 256, weights: dict | None = None,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         vocabulary: str = VOCABULARY, eos: int = EOS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32),
    doc_tokens, sequence_id, offset, source. ``weights`` maps sources to target
    shares (default: their share of all ids); ``quantum`` at most ``seq_len``."""
    if not 0 < quantum <= seq_len:
        raise ValueError("quantum must lie between 1 and seq_len")
    rows = stored(tokenised(docs, id_col, text_col, source_col, vocabulary, eos), "packing")
    per_task = rows.groupBy("g", "part").agg(F.sum("n").alias("n"))
    totals = {r["g"]: r["n"] for r in per_task.groupBy("g").agg(F.sum("n").alias("n")).collect()}
    keyed = {("n" if s is None else f"v{s}"): x for s, x in weights.items()} if weights else None
    table = queue_table(totals, quantum, keyed)
    number = {g: i for i, g in enumerate(table[0])}
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("g", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = small_join(rows, base, ["g", "part"]).select("id", "g", (F.col("start") + F.col("base")).alias("start"), "n", "ids")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, groups = batch.column(4).to_pylist(), batch.column(1).to_pylist()
            row, low, length, seq, off = cut(
                ids, np.array([number[g] for g in groups]), batch.column(2).to_numpy(), batch.column(3).to_numpy(),
                table, quantum, seq_len)
            wide = [np.frombuffer(x, dtype="<u2").astype("<u4").tobytes() for x in ids]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(low), pa.array(length),
                 pa.array([wide[r][4 * a:4 * (a + b)] for r, a, b in zip(row.tolist(), low.tolist(), length.tolist())], pa.binary()),
                 batch.column(3).take(take), pa.array(seq), pa.array(off),
                 pa.array([g[1:] if g[0] == "v" else None for g in (groups[r] for r in row.tolist())], pa.string())],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "source"])

    return placed.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long, source string")
