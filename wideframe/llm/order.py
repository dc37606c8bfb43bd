"""Token-ID / binary output (operator 10): training-order materialisation.

Documents become one stream of ids per input task (an end id after each), cut
into sequences of ``seq_len`` ids. Sequence ``i`` of ``n`` gets the global slot
``Feistel(key, i)``: a keyed permutation of the smallest even-bit domain that
holds ``n``, walked along its cycle until it falls below ``n``. Slots are cut
into ranges of ``per_shard``; one task writes each range as a file of
fixed-stride records, so a reader finds slot ``s`` in file ``s // per_shard``
at byte ``(s % per_shard) * stride`` and can resume at any slot.

Scale: ids are stored once, compressed; per-task totals number the sequences;
the one shuffle moves compressed blocks of the sequences that a task sends to
a shard. A shard holds at most ``per_shard`` records, so a writer's memory is
bounded; files are written under a temporary name and renamed, and a repeated
task writes the same bytes.

Defined cases: null or empty text is one end id; repeated rows are kept; an
empty table gives no rows and no files; a null id is listed as -1. The last sequence of a task is padded
with ``PAD`` (its ``n_ids`` tells). The folder must be one that ``pyarrow.fs``
opens (file, hdfs, s3, gs).
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, small_join, stored
from .tokens import EOS, VOCABULARY, tokenised

PAD = 0
ROUNDS = 6
_M = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of the given sequence numbers: a permutation of 0 to n - 1."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    keys = [_mix(np.array([(key + r * 0x9E3779B97F4A7C15) & int(_M)], dtype=np.uint64))[0] for r in range(1, ROUNDS + 1)]

    def once(x):
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right ^ k) & mask)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= n).any():  # the domain is below 4 n: few steps
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def read_slots(path: str, start: int, count: int, seq_len: int, per_shard: int) -> np.ndarray:
    """Ids of ``count`` slots from ``start`` on, as a (count, seq_len) array."""
    fs, root = _open(path)
    parts, stride = [], 2 * seq_len
    while count > 0:
        shard, record = divmod(start, per_shard)
        here = min(count, per_shard - record)
        with fs.open_input_file(f"{root}/{shard_name(shard)}") as f:
            f.seek(record * stride)
            parts.append(f.read(here * stride))
        got = len(parts[-1]) // stride
        if got < here:
            break
        start, count = start + here, count - here
    return np.frombuffer(b"".join(parts), dtype="<u2").reshape(-1, seq_len)


def materialise(docs: DataFrame, path: str | None = None, seq_len: int = 512, per_shard: int = 8192, key: int = 1,
                id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, eos: int = EOS) -> DataFrame:
    """Write the shards below ``path`` (default: a new folder in the shared
    one) and return a row per sequence: slot, shard, record, n_ids, ids_crc32
    (of the stored record's ids), doc_ids (of the documents in it), path."""
    spark = docs.sparkSession
    path = path or scratch(spark, "slots")
    rows = stored(tokenised(docs, id_col, text_col, None, vocabulary, eos), "ids")
    per_task = rows.groupBy("part").agg(F.sum("n").alias("n"))
    per_task = per_task.select("part", F.expr(f"CAST((n + {seq_len - 1}) DIV {seq_len} AS BIGINT)").alias("seqs"))
    total = per_task.agg(F.sum("seqs")).first()[0] or 0
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("part", F.coalesce(F.sum("seqs").over(earlier), F.lit(0)).alias("base"))
    placed = small_join(rows, base, "part").select("id", "part", "start", "n", "base", "ids")

    def fragments(batches):
        """Blocks (shard, slots, offsets, lengths, doc ids, ids): the parts of
        sequences that a batch of documents holds, per shard, compressed."""
        import zstandard

        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            if not batch.num_rows:
                continue
            doc = batch.column(0).fill_null(-1).to_numpy()
            start, n, first = (batch.column(i).to_numpy() for i in (2, 3, 4))
            ids = batch.column(5).to_pylist()
            low, high = start // seq_len, (start + n - 1) // seq_len
            count = high - low + 1
            row = np.repeat(np.arange(len(ids)), count)
            seq = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[row]
            a = np.maximum(seq * seq_len, start[row])
            b = np.minimum((seq + 1) * seq_len, (start + n)[row])
            slot = feistel(first[row] + seq, total, key)
            shard = slot // per_shard
            order = np.argsort(shard, kind="stable")
            bounds = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0])
            out = []
            for x in np.split(order, bounds[1:]):
                r, lo = row[x], (a - start[row])[x]
                data = b"".join(ids[i][2 * s:2 * (s + m)] for i, s, m in zip(r.tolist(), lo.tolist(), (b - a)[x].tolist()))
                head = np.stack([slot[x], (a - seq * seq_len)[x], (b - a)[x], doc[r]]).astype("<i8").tobytes()
                out.append((int(shard[x[0]]), pack.compress(head), pack.compress(data)))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                                              pa.array(cols[2], pa.binary())], names=["shard", "head", "data"])

    blocks = placed.mapInArrow(fragments, "shard long, head binary, data binary")
    return (blocks.groupBy("shard")
            .applyInPandas(lambda pdf: write_shard(pdf, path, seq_len, per_shard, total), "slot long, shard long, record long, n_ids long, ids_crc32 long, doc_ids array<long>")
            .withColumn("path", F.lit(path)))


def write_shard(pdf: pd.DataFrame, path: str, seq_len: int, per_shard: int, total: int) -> pd.DataFrame:
    """Fill one shard's records from its blocks, write the file, list its records."""
    import uuid

    import zstandard

    unpack = zstandard.ZstdDecompressor()
    shard = int(pdf["shard"].iloc[0])
    first = shard * per_shard
    size = min(per_shard, total - first)
    records = np.full((size, seq_len), PAD, dtype="<u2")
    used, docs = np.zeros(size, dtype=np.int64), [[] for _ in range(size)]
    for head, data in zip(pdf["head"], pdf["data"]):
        parts = np.frombuffer(unpack.decompress(head), dtype="<i8").reshape(4, -1)
        ids, at = np.frombuffer(unpack.decompress(data), dtype="<u2"), 0
        for slot, off, length, doc in parts.T.tolist():
            records[slot - first, off:off + length] = ids[at:at + length]
            at += length
            used[slot - first] += length
            docs[slot - first].append((off, doc))
    fs, root = _open(path)
    fs.create_dir(root, recursive=True)
    name = f"{root}/{shard_name(shard)}"
    temp = f"{name}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temp) as f:
        f.write(records.tobytes())
    fs.move(temp, name)
    return pd.DataFrame({
        "slot": np.arange(first, first + size), "shard": shard, "record": np.arange(size), "n_ids": used,
        "ids_crc32": [zlib.crc32(records[i, :used[i]].astype("<u4").tobytes()) for i in range(size)],
        "doc_ids": [[d for _, d in sorted(x, key=lambda y: y[0])] for x in docs]})
