"""LM scoring (operator 2): a log-bilinear model trained in numpy with
noise-contrastive estimation (NCE).

Tokens are lower-cased words and one end per text. The ``top`` most frequent
training words, an entry for all other words, and the end are the model's
outputs; the two preceding entries are its context. An output ``o`` scores
``(c1 * r[w1] + c2 * r[w2]) . q[o] + b[o]``. Every task trains a copy on all
training tokens of its part (NCE against the unigram distribution, shared
noise per batch, AdaGrad), copies are averaged by their number of tokens. The
probabilities are normalised exactly: with E1 = exp(scores of w1 + b) and
E2 = exp(scores of w2), all normalisers are the matrix product E1 E2'. A word
outside the outputs gets P(other | context) times its smoothed share of the
other words, so the probabilities of all words sum to 1.

Scale: texts are read once and stored as chunks of bounded size, coded by a
vocabulary per chunk; (chunk, word, count) rows meet their global counts by
word, go back to their chunk, and every document is stored as its sequence of
outputs. Model size is fixed by ``top`` and ``dim``; copies are summed in a
tree, so at most ``FAN`` of them reach one task or the driver.

Defined cases: null text is empty (one token, the end); a null id counts as an
empty one for the hold-out rule; repeated rows count each time; without
training documents every count is 0 and the model is uniform over its two
outputs; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, slices, stored

CHUNK_BYTES = 4 << 20
FAN = 32
ALPHA = 0.1


def coded_chunks(docs: DataFrame) -> DataFrame:
    """From (id, held, text): rows of documents (chunk, id, held, ids in the
    chunk's vocabulary) and rows of words (chunk, local, word, cnt in training)."""

    class Vocabulary(dict):
        def __missing__(self, word):
            self[word] = n = len(self)
            return n

    def run(batches):
        from pyspark import TaskContext

        part, number, size = TaskContext.get().partitionId(), 0, 0
        words, coded = Vocabulary(), []

        def flush():
            chunk = (part << 32) + number
            held = np.array([h for _, h, _ in coded])
            train = [c for _, h, c in coded if not h]
            count = np.bincount(np.concatenate(train), minlength=len(words)) if train else np.zeros(len(words), np.int64)
            n, m = len(coded), len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * n, pa.int64()), pa.array([i for i, _, _ in coded], pa.int64()), pa.array(held.tolist(), pa.bool_()),
                 pa.array([c.astype("<u4").tobytes() for _, _, c in coded], pa.binary()), pa.nulls(n, pa.int32()),
                 pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64())], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk] * m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary()),
                 pa.array(np.arange(m, dtype=np.int32)), pa.array(list(words), pa.binary()), pa.array(count.astype(np.int64))], names=names)

        for batch in (piece for whole in batches for piece in slices(whole, 2)):
            for i, h, text in zip(*(batch.column(c).to_pylist() for c in range(3))):
                ws = (text or "").encode().lower().split()
                coded.append((i, h, np.fromiter(map(words.__getitem__, ws), dtype=np.int64, count=len(ws))))
                size += len(text or "")
                if size >= CHUNK_BYTES:
                    yield from flush()
                    number, size, words, coded = number + 1, 0, Vocabulary(), []
        if coded:
            yield from flush()

    names = ["chunk", "id", "held", "ids", "local", "word", "cnt"]
    return docs.mapInArrow(run, "chunk long, id long, held boolean, ids binary, local int, word binary, cnt long")


def outputs_of(chunks: DataFrame, totals: dict, top: DataFrame, counted: DataFrame) -> DataFrame:
    """Per document: held, n_tokens, n_known, base, tail (log10 share of the
    words outside the outputs) and outs (uint16 outputs, end included)."""
    n, v, ends, k = (totals[x] for x in ("tokens", "types", "ends", "top"))
    tail_n, tail_v = totals["tail_tokens"], totals["tail_types"]

    def code(docs: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        m = len(words)
        local = words["local"].to_numpy(dtype=np.int64)
        count, out = np.zeros(m + 1), np.full(m + 1, k, dtype=np.int64)
        count[local] = words["c"].to_numpy(dtype=float)
        out[local] = words["out"].to_numpy(dtype=np.int64)
        count[m], out[m] = ends, k + 1
        base = np.log10((count + ALPHA) / (n + ALPHA * (v + 1)))
        tail = np.where(out == k, np.log10((count + ALPHA) / (tail_n + ALPHA * (tail_v + 1))), 0.0)
        rows = []
        for i, h, ids in zip(docs["id"], docs["held"], docs["ids"]):
            x = np.append(np.frombuffer(ids, dtype="<u4").astype(np.int64), m)
            rows.append((i, h, len(x), int((count[x] > 0).sum()), float(base[x].sum()), float(tail[x].sum()),
                         out[x].astype("<u2").tobytes()))
        return pd.DataFrame(rows, columns=["id", "held", "n_tokens", "n_known", "base", "tail", "outs"]).astype({"id": "Int64"})

    docs = chunks.filter("ids IS NOT NULL").select("chunk", "id", "held", "ids")
    words = (counted.join(F.broadcast(top), "word", "left")
             .select("chunk", "local", "c", F.coalesce("out", F.lit(k)).alias("out")))
    return docs.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInPandas(
        code, "id long, held boolean, n_tokens long, n_known long, base double, tail double, outs binary")


class LogBilinear:
    """Two-word context; outputs 0 to k + 1, context entry k + 2 is the start."""

    def __init__(self, counts: np.ndarray, dim: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        o = len(counts)
        self.noise = (counts + ALPHA) / (counts + ALPHA).sum()
        self.r = rng.normal(0, 0.1, (o + 1, dim)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (o, dim)).astype(np.float32)
        self.c = np.stack([np.ones(dim), np.full(dim, 0.5)]).astype(np.float32)
        self.b = np.log(self.noise).astype(np.float32)
        self.square = [np.full_like(p, 1e-3) for p in self.params()]  # AdaGrad

    def params(self) -> list[np.ndarray]:
        return [self.r, self.q, self.c, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.params()]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for p in self.params():
            p[...] = flat[at:at + p.size].reshape(p.shape)
            at += p.size

    def train(self, target, w1, w2, noise: int = 64, batch: int = 4096, rate: float = 0.05, seed: int = 9) -> None:
        rng = np.random.default_rng(seed)
        log_kp = np.log(noise * self.noise).astype(np.float32)
        cumulative = np.cumsum(self.noise)
        for s in range(0, len(target), batch):
            t, a, b = target[s:s + batch], w1[s:s + batch], w2[s:s + batch]
            m = len(t)
            ra, rb, qt = self.r[a], self.r[b], self.q[t]
            h = self.c[0] * ra + self.c[1] * rb
            z = np.minimum(np.searchsorted(cumulative, rng.random(noise)), len(cumulative) - 1)
            qz = self.q[z]
            # gradients of the logistic losses by score
            gt = _sigmoid((h * qt).sum(axis=1) + self.b[t] - log_kp[t]) - 1
            gz = _sigmoid(h @ qz.T + (self.b[z] - log_kp[z]))
            gh = gt[:, None] * qt + gz @ qz
            grad_q = _rows(np.r_[t, z], np.concatenate([gt[:, None] * h, gz.T @ h]), self.q.shape)
            grad_r = _rows(np.r_[a, b], np.concatenate([gh * self.c[0], gh * self.c[1]]), self.r.shape)
            grad_b = (np.bincount(t, weights=gt, minlength=len(self.b))
                      + np.bincount(z, weights=gz.sum(axis=0), minlength=len(self.b)))
            grad_c = np.stack([(gh * ra).sum(axis=0), (gh * rb).sum(axis=0)])
            for p, g, sq in zip(self.params(), (grad_r, grad_q, grad_c, grad_b), self.square):
                g = g / np.float32(m ** 0.5)
                sq += g * g
                p -= rate * g / np.sqrt(sq)

    def tables(self):
        """Scores of each context entry for each output, and the log
        normaliser of each pair of context entries."""
        s1 = (self.c[0] * self.r) @ self.q.T + self.b
        s2 = (self.c[1] * self.r) @ self.q.T
        top1, top2 = s1.max(axis=1, keepdims=True), s2.max(axis=1, keepdims=True)
        z = np.exp((s1 - top1).astype(np.float64)) @ np.exp((s2 - top2).astype(np.float64)).T
        return s1.astype(np.float32), s2.astype(np.float32), (np.log(z) + top1 + top2.T).astype(np.float32)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _rows(index, grad, shape):
    """Sum of gradient rows by index."""
    out = np.zeros(shape, dtype=np.float32)
    order = np.argsort(index.astype(np.int16 if shape[0] < 2 ** 15 else np.int64), kind="stable")
    index = index[order]
    start = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    out[index[start]] = np.add.reduceat(grad[order], start, axis=0)
    return out


def windows(outs: list[bytes], start: int):
    """Targets and their two context entries over some documents, with the
    first position of each document."""
    docs = [np.frombuffer(x, dtype="<u2") for x in outs]
    first = np.cumsum([0] + [len(d) for d in docs[:-1]])
    t = np.concatenate(docs).astype(np.int64)
    w1, w2 = np.r_[start, t[:-1]], np.r_[start, start, t[:-2]][:len(t)]
    w1[first], w2[first] = start, start
    second = first[np.diff(np.r_[first, len(t)]) > 1] + 1
    w2[second] = start
    return t, w1, w2, first


def trained(rows: DataFrame, counts: np.ndarray, dim: int) -> LogBilinear:
    model = LogBilinear(counts, dim)
    start = len(counts)

    def fit(batches):
        from collections import deque

        mine, n, pending, size = LogBilinear(counts, dim), 0, deque(), 0
        for batch in batches:
            for x in batch.column(0).to_pylist():
                pending.append(x)
                size += len(x) // 2
                if size >= 1 << 18:
                    t, a, b, _ = windows(list(pending), start)
                    mine.train(t, a, b, seed=n)
                    n, size = n + len(t), 0
                    pending.clear()
        if pending:
            t, a, b, _ = windows(list(pending), start)
            mine.train(t, a, b, seed=n)
            n += len(t)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([(n * mine.flat()).tobytes()], pa.binary())],
                                             names=["n", "w"])

    def add(batches):
        n, w = 0, None
        for batch in batches:
            for m, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(x)
                n, w = n + m, x if w is None else w + x
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([w.tobytes()], pa.binary())], names=["n", "w"])

    copies = stored(rows.filter("NOT held").select("outs").mapInArrow(fit, "n long, w binary"), "models")
    while (m := copies.count()) > FAN:
        copies = stored(copies.repartition(-(-m // FAN)).mapInArrow(add, "n long, w binary"), "models")
    got = copies.collect()
    if got:
        model.load(sum(np.frombuffer(r["w"]) for r in got) / sum(r["n"] for r in got))
    return model


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", top: int = 2000, dim: int = 32,
                    held_out: str | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score).
    ``held_out`` is SQL for the documents that are not learned from."""
    spark = docs.sparkSession
    ship(spark)
    rule = held_out or f"pmod(crc32(CAST(coalesce(CAST(`{id_col}` AS STRING), '') AS BINARY)), 10) = 0"
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.expr(rule).alias("held"), F.col(text_col).alias("text"))
    chunks = stored(coded_chunks(plain), "chunks")
    ends = chunks.filter("ids IS NOT NULL AND NOT held").count()
    by_word = Window.partitionBy("word")
    counted = stored(chunks.filter("word IS NOT NULL").select("chunk", "local", "word", F.sum("cnt").over(by_word).alias("c"),
                     F.row_number().over(by_word.orderBy("chunk")).alias("nth")), "counts")
    known = counted.filter("nth = 1 AND c > 0")
    total = known.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    best = known.orderBy(F.desc("c"), "word").limit(top).select("word", "c").collect()
    names = spark.createDataFrame([(bytes(r["word"]), i) for i, r in enumerate(best)], "word binary, out int")
    in_top = sum(r["c"] for r in best)
    totals = {"tokens": (total["n"] or 0) + ends, "types": total["v"] + (ends > 0), "ends": ends, "top": len(best),
              "tail_tokens": (total["n"] or 0) - in_top, "tail_types": total["v"] - len(best)}
    rows = stored(outputs_of(chunks, totals, names, counted), "outputs")

    counts = np.array([r["c"] for r in best] + [totals["tail_tokens"], ends], dtype=float)
    sent = spark.sparkContext.broadcast(trained(rows, counts, dim).tables())
    start = len(counts)

    def run(batches):
        s1, s2, norm = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            t, a, b, first = windows(batch.column(6).to_pylist(), start)
            logp = s1[a, t] + s2[b, t] - norm[a, b]
            total = np.add.reduceat(logp.astype(np.float64), first) / np.log(10) + batch.column(5).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(5)] + [pa.array(total)],
                                             names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = rows.mapInArrow(run, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(totals["tokens"]).cast("long"))
