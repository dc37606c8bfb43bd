"""Exact n-gram Jaccard join by PartEnum signatures (operator 11).

A document's set holds its distinct ``k``-word shingles (64-bit hashes).
Documents with equal sets are one class. Two classes link when 100 *
intersection >= threshold * union. All links are found: the method is exact.

Signatures. Sizes are cut into bands. Linked sets lie in the same or in
neighbouring bands, and differ in at most d elements, where d follows from the
upper end of the band. For a band the feature domain (all shingle hashes) is
partitioned into n1 first-level parts of n2 second-level parts each. With n1 =
d // (k2 + 1) + 1 + spare, at least 1 + spare first-level parts of two linked
sets hold at most k2 differing second-level parts, so there some subset of n2 -
k2 second-level parts agrees in full. A signature is the hash of a set's
elements in one such subset; every set emits those of its own band, and those
of the next band if a set there can be similar. (n1, n2, k2) are chosen per
band (``levels``): fewest signatures that still hold about ``size`` elements.

Signatures of fewer than ``least`` elements say little and would be shared by
many sets. A set emits them only if more than ``spare`` of its first-level
parts have such a subset: otherwise an agreeing part with larger subsets is
left, in it and in any linked set.

Links. Signature rows are range-partitioned by (signature, class), so a crowd
behind one signature spans several tasks; rows alone with their signature are
dropped. Then ``rounds``: every signature group with several components has a
member as hub, another one each round; each class is compared with that hub,
not tried before, with which it shares most signatures; links join components.
So a crowd of near copies costs a few comparisons a member. At last every pair
of a group that is not yet in one component is compared. Comparisons go
by a parity sketch first (differing parities never exceed the differing
elements, so it only rejects pairs that are too far apart), then by full sets.

Scale: a set sends about a fifth of its size in signatures; full sets are made
only for classes that share a signature. Nothing is gathered per group, class
or component.

Defined cases: null or empty text has no shingles and is linked with nothing
(its component is its own id); fewer than ``k`` words are one shingle; a null
id is linked with nothing and its component is null; rows that repeat an id are
one node with all their links; very long texts count whole; an empty table
gives no rows. Other columns take no part.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, slices, small_join, stored
from .components import components
from .forest import confirmed, mix64, shingle_sets

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Level:
    """A size band (low to high), the most elements in which linked sets up to
    ``high`` differ, and how the domain is partitioned for it."""
    low: int
    high: int
    differ: int
    n1: int = 0
    n2: int = 0
    k2: int = 0
    spare: int = 0

    @property
    def subsets(self) -> list[tuple[int, ...]]:
        return list(combinations(range(self.n2), self.n2 - self.k2))


def levels(threshold: int, largest: int = 2 ** 31, size: float = 6.0) -> list[Level]:
    """The bands up to ``largest`` elements. Bands span two steps of the
    threshold, so a set meets at most the next band."""
    out, low = [], 1
    while low <= largest:
        high = max(low, low * 10_000 // threshold ** 2)
        differ = 2 * (100 - threshold) * high // (100 + threshold)
        level = Level(low, high, differ)
        if differ:
            choices = []
            want = 1 + differ // 16
            for spare in sorted({0, 1, want // 2, want}):
                for k2 in range(1, 4):
                    n1 = differ // (k2 + 1) + 1 + spare
                    for n2 in range(k2 + 1, k2 + 5):
                        held = low * (n2 - k2) / (n1 * n2)
                        choices.append((held < size, max(0.0, size - held), want - spare, n1 * comb(n2, k2), n1, n2, k2, spare))
            best = min((c for c in choices if c[3] <= 4 * (differ + 2)), default=min(choices))
            level = Level(low, high, differ, *best[4:])
        out.append(level)
        low = high + 1
    return out


def own_levels(n: int, table: list[Level], lows: np.ndarray, threshold: int) -> list[int]:
    """The levels whose signatures a set of n elements emits."""
    b = int(np.searchsorted(lows, n, side="right")) - 1
    at = [b] if b + 1 >= len(table) or 100 * n // threshold < table[b + 1].low else [b, b + 1]
    return [i for i in at if table[i].differ]


def signatures(sets: list[np.ndarray], threshold: int, table: list[Level], least: int = 3) -> list[np.ndarray]:
    """The signatures (uint64) of each set of sorted 64-bit hashes."""
    lows = np.array([x.low for x in table])
    entries = sorted((level, i) for i, s in enumerate(sets) if len(s) for level in own_levels(len(s), table, lows, threshold))
    out: list[list[np.ndarray]] = [[] for _ in sets]
    at = 0
    while at < len(entries):
        number, end = entries[at][0], at
        while end < len(entries) and entries[end][0] == number:
            end += 1
        mine, level = [i for _, i in entries[at:end]], table[number]
        parts = level.n1 * level.n2
        h = np.concatenate([sets[i] for i in mine])
        base = np.repeat(np.arange(len(mine)) * parts, [len(sets[i]) for i in mine])
        part = ((h >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64) + base
        total = np.zeros(len(mine) * parts, dtype=_U)
        np.add.at(total, part, mix64(h ^ _GOLD))
        count = np.bincount(part, minlength=len(total)).reshape(len(mine), level.n1, level.n2)
        total = mix64(total.reshape(count.shape) + np.arange(1, level.n2 + 1, dtype=_U) * _GOLD)
        first = (np.arange(level.n1, dtype=_U) + _U(1)) * _U(0xD6E8FEB86659FD93) + _U(number)
        values, few = [], []
        for j, subset in enumerate(level.subsets):
            chosen = list(subset)
            with np.errstate(over="ignore"):
                values.append(mix64(total[:, :, chosen].sum(axis=2, dtype=_U) + first + _U(j) * _U(0xA0761D6478BD642F)))
            few.append(count[:, :, chosen].sum(axis=2) < least)
        value, weak = np.stack(values, axis=2), np.stack(few, axis=2)
        poor = weak.any(axis=2).sum(axis=1) > level.spare
        for row, i in enumerate(mine):
            out[i].append(value[row].ravel() if poor[row] else value[row][~weak[row]])
        at = end
    return [np.concatenate(x) if x else np.empty(0, _U) for x in out]


def parity(sets: list[np.ndarray]) -> list[bytes]:
    """Parities of the elements in as many places (a power of two) as the set
    has elements at least."""
    width = [max(64, 1 << (len(s) - 1).bit_length()) if len(s) else 0 for s in sets]
    start = np.cumsum([0] + width)
    if not start[-1]:
        return [b""] * len(sets)
    h = np.concatenate(sets)
    n = [len(s) for s in sets]
    place = (h & np.repeat(np.array(width, dtype=_U) - _U(1), n)).astype(np.int64) + np.repeat(start[:-1], n)
    odd = (np.bincount(place, minlength=start[-1]) & 1).astype(np.uint8)
    bits = np.packbits(odd, bitorder="little")
    return [bits[a // 8:b // 8].tobytes() for a, b in zip(start[:-1].tolist(), start[1:].tolist())]


def fold(sketch: np.ndarray, words: int) -> np.ndarray:
    """A parity sketch (last axis: 64-bit words) at a smaller width."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing parities (at most the number of differing elements)."""
    words = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(fold(x, words) ^ fold(y, words)).sum(axis=-1, dtype=np.int64)


def near(n, m, distance, threshold: int):
    """Whether sizes and distance allow a link."""
    low, high = np.minimum(n, m), np.maximum(n, m)
    return (100 * low >= threshold * high) & ((100 + threshold) * distance <= (100 - threshold) * (n + m))


def _key(s: np.ndarray) -> int:
    import xxhash

    return int(np.array([xxhash.xxh3_64_intdigest(s.tobytes())], dtype=_U).view(np.int64)[0])


def sign(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: int) -> DataFrame:
    """(id, n, cls, sigs, sketch) of every row; cls is a hash of the whole set."""
    ship(docs.sparkSession)
    table = levels(threshold)

    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1, 1_000_000)):
            sets = shingle_sets(batch.column(1).to_pylist(), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_key(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([x.tobytes() for x in signatures(sets, threshold, table)], pa.binary()), pa.array(parity(sets), pa.binary())],
                names=["id", "n", "cls", "sigs", "sketch"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n long, cls long, sigs binary, sketch binary")


def shared(classes: DataFrame) -> DataFrame:
    """(sig, cls) of the classes, without rows that are alone with their
    signature. A group may span tasks, so each task
    keeps its first and its last row."""

    def explode(batches):
        for batch in batches:
            sigs = batch.column(1).to_pylist()
            cls = np.repeat(batch.column(0).to_numpy(), [len(s) // 8 for s in sigs])
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(sigs), np.int64)), pa.array(cls)], names=["sig", "cls"])

    def several(batches):
        held = None  # the last row so far, and whether it is kept already
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, cls = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if held is not None:
                sig, cls = np.r_[held[0], sig], np.r_[held[1], cls]
            same = sig[1:] == sig[:-1]
            keep = np.r_[held is None or held[2], same] | np.r_[same, False]
            held = (sig[-1:], cls[-1:], keep[-1])
            yield pa.RecordBatch.from_arrays([pa.array(sig[:-1][keep[:-1]]), pa.array(cls[:-1][keep[:-1]])], names=["sig", "cls"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["sig", "cls"])

    rows = classes.select("cls", "sigs").mapInArrow(explode, "sig long, cls long")
    return rows.repartitionByRange("sig", "cls").sortWithinPartitions("sig", "cls").mapInArrow(several, "sig long, cls long")


def by_sketch(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that sizes and parity sketches do not rule out."""

    def run(batches):
        for batch in batches:
            a, b, n, m, x, y = (c.to_pylist() for c in batch.columns)
            distance = [int(apart(np.frombuffer(u, _U), np.frombuffer(v, _U))) for u, v in zip(x, y)]
            keep = pa.array(near(np.array(n), np.array(m), np.array(distance), threshold)) if a else pa.array([], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    one = classes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    two = classes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def block_pairs(x, y, threshold: int):
    """Pairs a < b between two blocks of one signature group (pandas frames sig,
    cls, component, n, sketch, groups) of different components that the sketches
    do not rule out. A pair that shares several large groups (``groups``, sorted)
    comes from the first one only."""
    import pandas as pd

    a, b = [], []
    width, sig = y["sketch"].map(len), x["sig"].iloc[0] if len(x) else 0
    for w in width.unique():
        part = y[width == w]
        held = np.frombuffer(b"".join(part["sketch"]), _U).reshape(len(part), -1)
        cls, comp, n, groups = part["cls"].to_numpy(), part["component"].to_numpy(), part["n"].to_numpy(), part["groups"].to_numpy()
        for c, p, m, s, mine in zip(x["cls"], x["component"], x["n"], x["sketch"], x["groups"]):
            at = np.flatnonzero((cls > c) & (comp != p) & (100 * np.minimum(n, m) >= threshold * np.maximum(n, m)))
            at = at[near(m, n[at], apart(np.frombuffer(s, _U), held[at]), threshold)]
            at = [i for i in at if np.intersect1d(mine, groups[i], assume_unique=True)[0] == sig]
            a += [c] * len(at)
            b += cls[at].tolist()
    return pd.DataFrame({"a": pd.Series(a, dtype="int64"), "b": pd.Series(b, dtype="int64")})


def all_pairs(live: DataFrame, classes: DataFrame, threshold: int, small: int, block: int) -> DataFrame:
    """(a, b) of all classes that share a signature and lie in different
    components (live: sig, cls, component), as far as the sketches do not rule
    them out. Groups of up to ``small`` members by a join, larger ones in
    blocks of about ``block`` members, of which only such pairs come back."""
    size = live.groupBy("sig").agg(F.count("*").alias("m"))
    few = live.join(size.filter(F.col("m") <= small).select("sig"), "sig")
    x, y = few.alias("x"), few.alias("y")
    pairs = x.join(y, F.expr("x.sig = y.sig AND x.cls < y.cls AND x.component <> y.component"))
    listed = by_sketch(pairs.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct(), classes, threshold)
    large = stored(live.join(size.filter(F.col("m") > small), "sig"), "large")
    if not large.limit(1).count():
        return listed
    groups = large.groupBy("cls").agg(F.sort_array(F.collect_list("sig")).alias("groups"))  # at most a class's own signatures
    full = stored(large.join(classes.select("cls", "n", "sketch"), "cls").join(groups, "cls"), "large-sketches").withColumn("blocks", F.expr(f"CAST(ceil(m / {block}) AS INT)"))
    every = F.explode(F.expr("sequence(0, blocks - 1)"))
    left = full.select("sig", F.expr("CAST(pmod(xxhash64(cls, 1), blocks) AS INT)").alias("i"), every.alias("j"), "cls", "component", "n", "sketch", "groups")
    right = full.select("sig", every.alias("i"), F.expr("CAST(pmod(xxhash64(cls, 2), blocks) AS INT)").alias("j"), "cls", "component", "n", "sketch", "groups")
    right = right.toDF(*right.columns)  # columns of its own, for the cogroup
    keys = ["sig", "i", "j"]

    def compare(x, y):
        return block_pairs(x, y, threshold)

    return listed.union(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "a long, b long")).distinct()


def full_sets(docs: DataFrame, classes: DataFrame, live: DataFrame, id_col: str, text_col: str, k: int, repeated: bool) -> DataFrame:
    """(id, set) of the classes in ``live``, ``id`` being the class; from the
    texts of one document each."""
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1, 1_000_000)):
            sets = shingle_sets(batch.column(1).to_pylist(), k)
            full = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_key(s) for s in full], pa.int64()), pa.array([s.tobytes() for s in full], pa.binary())],
                                             names=["id", "set"])

    needed = classes.join(live.select("cls").distinct(), "cls", "left_semi").select("id")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = small_join(texts, stored(needed, "needed"), "id", limit=2_000_000).select("id", "text").mapInArrow(run, "id long, set binary")
    return sets.dropDuplicates(["id"]) if repeated else sets


def link_classes(live: DataFrame, classes: DataFrame, sets: DataFrame, threshold: int, rounds: int, small: int, block: int):
    """(a, b) links that join the classes of ``live`` (sig, cls) as all links do, or None."""
    spark = live.sparkSession
    links = tested = None
    label = spark.createDataFrame([], "node long, component long")
    for turn in range(rounds + 1):
        named = live.select("sig", "cls").join(label.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        hub = (named.groupBy("sig").agg(F.min(F.struct(F.xxhash64("cls", F.lit(turn)).alias("h"), "cls", "component")).alias("hub"),
                                        F.min("component").alias("low"), F.max("component").alias("high"))
               .filter("low < high").select("sig", F.col("hub.cls").alias("hub"), F.col("hub.component").alias("hub_component")))
        live = stored(named.join(hub, "sig"), "live")
        if not live.limit(1).count():
            break
        if turn == rounds:
            pairs = all_pairs(live.select("sig", "cls", "component"), classes, threshold, small, block)
            pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        else:
            met = (live.filter("component <> hub_component").groupBy("cls", "hub").agg(F.count("*").alias("c"))
                   .withColumns({"a": F.least("cls", "hub"), "b": F.greatest("cls", "hub")}))
            met = met if tested is None else met.join(tested, ["a", "b"], "left_anti")
            best = met.groupBy("cls").agg(F.max(F.struct("c", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
            best = stored(best, "best")
            tested = best if tested is None else best.union(tested)
            pairs = by_sketch(best, classes, threshold)
        more = stored(confirmed(stored(pairs, "pairs"), sets, threshold), "links")
        if more.limit(1).count():
            links = more if links is None else stored(links.union(more), "links")
            label = components(links, links.count()) if turn < rounds else label
    return links


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 80,
                      rounds: int = 2, small: int = 32, block: int = 512) -> DataFrame:
    """(id, n_shingles, component_id), one row per row of ``docs``."""
    signed = stored(sign(docs, id_col, text_col, k, threshold), "signed")
    named = signed.filter("n > 0 AND id IS NOT NULL")
    classes = stored(named.groupBy("cls").agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("n", "sigs", "sketch"))), "classes")
    several = named.groupBy("id").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low < high")
    several = stored(named.select("id", "cls").join(several, "id").filter("cls <> low").select(F.col("low").alias("a"), F.col("cls").alias("b")).distinct(), "several")
    repeated = several.count()

    live = stored(shared(classes), "live")
    sets = stored(full_sets(docs, classes, live, id_col, text_col, k, repeated > 0), "sets")
    links = link_classes(live, classes.drop("sigs"), sets, threshold, rounds, small, block)
    if repeated:
        links = several if links is None else links.union(several)
    heads = classes.select("cls", F.col("id").alias("head"))
    if links is not None:
        label = components(links, links.count()).withColumnRenamed("node", "cls")
        least = heads.join(label, "cls").groupBy("component").agg(F.min("head").alias("least"))
        heads = heads.join(label.join(least, "component").select("cls", "least"), "cls", "left").withColumn("head", F.coalesce("least", "head"))
    out = signed.select("id", "n", "cls").join(heads.select("cls", "head"), "cls", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("head", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
