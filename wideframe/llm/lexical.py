"""Ranked lexical search by presence-mask grouping (operator 13).

Every item (query) is a set of terms; documents are ranked by a sum of integer
term scores. Terms are maximal runs of ASCII letters, digits and non-ASCII
characters, A-Z lower-cased.

Method. The documents of a task are cut into blocks of similar length; a block
keeps, for each term that some item holds, its documents and frequencies
(``postings``, stored once in the shared folder). A bitmap per term says which
documents of the block hold it. For an item, the bitmaps of the terms without
which the current kth score is out of reach are united; the documents in the
union are grouped by their mask of matched terms. A group's maximum score
follows from its terms' largest frequencies in the block and from its shortest
document. Groups are scored by descending maximum until the next one is below
the kth score; then nothing that is left can enter. The kth scores carry on
from block to block of a task.

Scale: texts are read once and never shuffled; corpus counts are added up per
task and then by one row per term; a task returns its k best documents per item
only, which are merged in two steps. Items are worked on in blocks of about
``item_terms`` terms (by a hash of the item), so what goes to every task is
bounded however many items there are; an item's own terms go together.

Defined cases: null or empty texts have no terms and are not counted; null ids
sort last; rows that repeat a document id are documents of their own; rows that
repeat an item id are one item with all their terms; an item without terms or
matches has no rows, an empty table gives none; very long texts count whole;
equal scores are ordered by document id. Other columns take no part.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, ship, slices

#: Java and RE2 syntax.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Byte by byte: A-Z to a-z, whatever is not part of a term to a space. Bytes
#: from 128 on belong to non-ASCII characters, which are part of terms.
FOLD = bytes((b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32) for b in range(256))

NO_ID = 2 ** 63 - 1


def terms_sql(text: str) -> str:
    """SQL for the array of terms of ``text``."""
    low = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all(coalesce({low}, ''), '{TERM}', 0)".replace("\\", "\\\\")


def term_part(tf, m):
    """The frequency part of a term's score (arrays or numbers)."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


POSTINGS = "docs long, terms_total long, ids binary, known binary, n binary, terms binary, counts binary, places binary, tf binary"


def postings(docs: DataFrame, vocabulary, id_col: str, text_col: str, block_docs: int = 4096, words: int = 4_000_000) -> DataFrame:
    """One row per block of up to ``block_docs`` documents of similar length:
    document ids and term counts, and for each term of the vocabulary (a
    broadcast dict from bytes to number) its documents and frequencies. A task
    gathers ``words`` words at least before it cuts blocks."""
    ship(docs.sparkSession)

    def block(ids, known, n, term, doc, tf):
        names, counts = np.unique(term, return_counts=True)
        return [int((n > 0).sum()), int(n.sum()), ids.tobytes(), known.tobytes(), n.tobytes(), names.astype("<i4").tobytes(),
                counts.astype("<i4").tobytes(), doc.astype("<u2").tobytes(), tf.astype("<u4").tobytes()]

    def cut(parts):
        """Blocks of the gathered (ids, known, n, term, doc, tf)."""
        shift = np.cumsum([0] + [len(p[0]) for p in parts])
        ids, known, n, term = (np.concatenate([p[i] for p in parts]) for i in range(4))
        doc = np.concatenate([p[4] + s for p, s in zip(parts, shift)])
        tf = np.concatenate([p[5] for p in parts])
        order = np.argsort(n, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        doc = place[doc]
        by = np.lexsort((doc, term, doc // block_docs))
        term, doc, tf = term[by], doc[by], tf[by]
        edge = np.searchsorted(doc // block_docs, np.arange(-(-len(order) // block_docs) + 1))
        rows = []
        for b, (low, high) in enumerate(zip(edge[:-1], edge[1:])):
            mine = order[b * block_docs:(b + 1) * block_docs]
            rows.append(block(ids[mine], known[mine], n[mine], term[low:high], doc[low:high] - b * block_docs, tf[low:high]))
        return rows

    def run(batches):
        get = vocabulary.value.get
        held, size = [], 0

        def out(parts):
            columns = list(zip(*cut(parts)))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                                               *(pa.array(c, pa.binary()) for c in columns[2:])],
                                              names=[x.split()[0] for x in POSTINGS.split(", ")])

        for batch in (piece for whole in batches for piece in slices(whole, 1)):
            found = [(t or "").encode().translate(FOLD).split() for t in batch.column(1).to_pylist()]
            n = np.array([len(w) for w in found], dtype=np.int64)
            number = np.fromiter(map(get, itertools.chain.from_iterable(found), itertools.repeat(-1)), np.int64, int(n.sum()))
            doc = np.repeat(np.arange(len(n)), n)[number >= 0]
            pair, tf = np.unique(number[number >= 0] * len(n) + doc, return_counts=True)
            ids = batch.column(0)
            held.append((ids.fill_null(NO_ID).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8),
                         n, pair // len(n), pair % len(n), tf))
            size += int(n.sum()) + len(n)
            if size >= words:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, POSTINGS)


def counts(stored: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and documents per term. A task
    adds up its blocks; at most ``n_terms`` rows reach the driver."""

    def run(batches):
        total, df = np.zeros(2, dtype=np.int64), np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            for docs, terms, names, found in zip(*(c.to_pylist() for c in batch.columns)):
                total += (docs, terms)
                df[np.frombuffer(names, "<i4")] += np.frombuffer(found, "<i4")
        term = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, term]), pa.array(np.r_[total, df[term]])], names=["term", "n"])

    rows = stored.select("docs", "terms_total", "terms", "counts").mapInArrow(run, "term long, n long")
    got = dict(rows.groupBy("term").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False))
    df = np.zeros(n_terms, dtype=np.int64)
    for t, n in got.items():
        if t >= 0:
            df[t] = n
    return got.get(-1, 0), got.get(-2, 0), df


class Best:
    """The k best documents of an item so far: highest score, then smallest id."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.known = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint8)

    def floor(self) -> int:
        """What a document must reach to enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score, ids, known) -> None:
        ok = score >= self.floor()
        score, ids, known = (np.concatenate([a, b[ok]]) for a, b in ((self.score, score), (self.id, ids), (self.known, known)))
        order = np.lexsort((1 - known, ids, -score))[:self.k]
        self.score, self.id, self.known = score[order], ids[order], known[order]


class Block:
    """The postings of one block, with bitmaps made on demand."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], np.uint8)
        n = np.frombuffer(row["n"], np.int64)
        self.m = 50 + (50 * n * n_docs) // max(n_terms, 1)
        names, found = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["counts"], "<i4").astype(np.int64)
        self.place, self.tf = np.frombuffer(row["places"], "<u2"), np.frombuffer(row["tf"], "<u4").astype(np.int64)
        at = np.cumsum(found) - found
        self.at = dict(zip(names.tolist(), zip(at.tolist(), (at + found).tolist())))
        self.most = dict(zip(names.tolist(), np.maximum.reduceat(self.tf, at).tolist())) if len(names) else {}
        self.bits: dict[int, np.ndarray] = {}
        self.shortest = int(self.m[n > 0].min()) if (n > 0).any() else 0

    def bitmap(self, term: int) -> np.ndarray:
        if term not in self.bits:
            low, high = self.at[term]
            holds = np.zeros(len(self.ids), dtype=bool)
            holds[self.place[low:high]] = True
            self.bits[term] = np.packbits(holds)
        return self.bits[term]

    def frequency(self, term: int, docs: np.ndarray) -> np.ndarray:
        low, high = self.at[term]
        place = self.place[low:high]
        at = np.minimum(np.searchsorted(place, docs), len(place) - 1)
        return np.where(place[at] == docs, self.tf[low:high][at], 0)

    def score(self, terms, weight, docs: np.ndarray) -> np.ndarray:
        total, m = np.zeros(len(docs), dtype=np.int64), self.m[docs]
        for t in terms:
            total += weight[t] * term_part(self.frequency(t, docs), m)
        return total

    def masks(self, terms: list[int], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct masks (a row of booleans over the terms each) and every
        document's mask number."""
        byte, bit = docs >> 3, (7 - (docs & 7)).astype(np.uint8)
        words = []
        for first in range(0, len(terms), 63):
            code = np.zeros(len(docs), dtype=np.int64)
            for j, t in enumerate(terms[first:first + 63]):
                code |= ((self.bitmap(t)[byte] >> bit) & 1).astype(np.int64) << j
            words.append(code)
        if len(words) == 1:
            distinct, number = np.unique(words[0], return_inverse=True)
            distinct = distinct[:, None]
        else:
            distinct, number = np.unique(np.column_stack(words), axis=0, return_inverse=True)
        held = [(distinct[:, j // 63] >> (j % 63)) & 1 for j in range(len(terms))]
        return np.column_stack(held).astype(bool), number.reshape(-1)

    def search(self, terms, weight: np.ndarray, best: Best, least: int = 64) -> None:
        """Add this block's documents that can be among an item's best."""
        top = {t: int(weight[t]) * term_part(self.most[t], self.shortest) for t in terms if t in self.most and weight[t] > 0}
        terms = sorted(top, key=lambda t: (-top[t], t))
        rest = np.cumsum([top[t] for t in reversed(terms)])[::-1]  # the most that this term and the later ones give
        needed = [t for t, r in zip(terms, rest) if r >= best.floor()]
        if not needed:
            return
        union = np.bitwise_or.reduce([self.bitmap(t) for t in needed])
        docs = np.flatnonzero(np.unpackbits(union, count=len(self.ids)))
        held, number = self.masks(terms, docs)
        # the shortest document of a group bounds what its terms can give
        shortest = np.full(len(held), NO_ID, dtype=np.int64)
        np.minimum.at(shortest, number, self.m[docs])
        most = np.array([self.most[t] for t in terms], dtype=np.int64)
        part = np.array([weight[t] for t in terms], dtype=np.int64) * term_part(most[None, :], shortest[:, None])
        bound = np.where(held, part, 0).sum(axis=1)
        order = np.argsort(-bound, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        by = np.argsort(place[number], kind="stable")  # documents by group, best group first
        end = np.cumsum(np.bincount(place[number], minlength=len(order)))
        at = group = 0
        while group < len(order) and bound[order[group]] >= best.floor():
            # some groups at once: as many as hold ``least`` documents
            last = min(int(np.searchsorted(end, at + least)), len(order) - 1)
            while bound[order[last]] < best.floor():
                last -= 1
            mine = np.sort(docs[by[at:end[last]]])
            best.add(self.score(terms, weight, mine), self.ids[mine], self.known[mine])
            at, group = int(end[last]), last + 1


def best_of_tasks(stored: DataFrame, items, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, task, doc_id, score): the k best documents of each task and item.
    ``items`` is a broadcast list of term numbers per item."""
    spark = stored.sparkSession
    weights = spark.sparkContext.broadcast(weight)

    def run(batches):
        from pyspark import TaskContext

        asked, w, task = items.value, weights.value, TaskContext.get().partitionId()
        best = [Best(k) for _ in asked]
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block({name: batch.column(name)[at].as_py() for name in batch.schema.names}, n_docs, n_terms)
                for terms, b in zip(asked, best):
                    block.search(terms, w, b)
        n = [len(b.score) for b in best]
        ids, known = np.concatenate([b.id for b in best]), np.concatenate([b.known for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(best)), n)), pa.array(np.full(sum(n), task)), pa.array(ids, mask=known == 0),
             pa.array(np.concatenate([b.score for b in best]))], names=["item", "task", "doc_id", "score"])

    return stored.select("ids", "known", "n", "terms", "counts", "places", "tf").mapInArrow(
        run, "item long, task long, doc_id long, score long")


def ranked(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", k: int = 50, item_terms: int = 200_000, block_docs: int = 4096) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's k best documents."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("item_id"), F.explode(F.expr(terms_sql(f"`{item_text}`"))).alias("term")).distinct()
    blocks = max(1, math.ceil(asked.count() / item_terms))
    kind = asked.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for b in range(blocks):
        mine = asked.filter(F.expr(f"pmod(xxhash64(item_id), {blocks}) = {b}"))
        rows = mine.groupBy("item_id").agg(F.collect_list("term").alias("terms")).collect()
        if not rows:
            continue
        names = sorted({t for r in rows for t in r["terms"]})
        number = {t: i for i, t in enumerate(names)}
        vocabulary = spark.sparkContext.broadcast({t.encode(): i for t, i in number.items()})
        path = scratch(spark, "postings")
        postings(docs, vocabulary, id_col, text_col, block_docs).write.option("compression", "zstd").parquet(path)
        stored = spark.read.schema(POSTINGS).parquet(path)
        n_docs, n_terms, df = counts(stored, len(names))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
        lists = spark.sparkContext.broadcast([sorted(number[t] for t in r["terms"]) for r in rows])
        best = best_of_tasks(stored, lists, weight, n_docs, n_terms, k)
        best = ranked(best.withColumn("part", F.expr("task DIV 256")), ["item", "part"], k).drop("rank")
        key = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {kind}")
        out = out.union(ranked(best, ["item"], k).join(F.broadcast(key), "item").select("item_id", "rank", "doc_id", "score"))
    return out
