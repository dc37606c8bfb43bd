"""MinHash near-dedup (operator 4): an LSH forest over word shingles.

A document's set holds its distinct ``k``-word shingles. Documents with equal
sets are one class (by a 128-bit key of the whole set). Each class goes into
``trees`` sorted orders of its MinHash values. Neighbours that share at least
the first ``depth`` values form a region; a region of more than ``region``
classes is cut again by the next value, and so on to ``depth + extra`` values:
the depth adapts to how crowded a region is. All pairs of a small region are
candidates; in a region that stays large at full depth a class is paired with
its ``window`` neighbours of longest common prefix.

Candidates are confirmed on the full sets (100 * intersection >= threshold *
union). Confirmation goes by rounds: the forest is read, each class is compared
with its most promising partner in another component, components are joined;
after a few rounds the forest is read once more for every pair between
different components. A pair inside a component is not needed, so pairs of a
crowd of near copies are never listed; a class without a partner in another
component leaves the later rounds. Regions that stayed large are then finished
exactly: every member outside the largest component is compared, on the full
sets and block by block, with every member of another component.

All values of all trees come from hash functions of their own. With 32 trees a
pair of similarity 0.8 that meets at depth 4 is missed with probability
(1 - 0.8**4)**32 = 5e-8, in the most crowded regions (depth 8) with 0.3 percent
per link, and then only if no other link joins the two.
The sketch filter (128 one-bit values, at most 34 different) loses a pair of
similarity 0.8 with probability below 1e-7.

Scale: shuffles carry signatures and pairs; texts are read again only for
documents in candidate pairs, and no task holds a region, class or component.

Defined cases: null or empty text has no shingles, is linked with nothing and
kept; fewer than ``k`` words are one shingle; a null id is linked with nothing
and kept; rows that repeat an id are one node with all their links; an empty
table gives no rows. Output columns replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, slices, small_join, stored
from .components import components

SKETCH_LIMIT = 34

#: Largest table of ids (rows of two numbers at most) that is sent to every
#: task, so that signatures and sets need no shuffle to be filtered or named.
IDS = 2_000_000

_U = np.uint64


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2 ** 63, n, dtype=np.uint64) * _U(2) + _U(1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the public splitmix64 generator (in place)."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class WordHash(dict):
    """Word to 64-bit hash; cleared when it holds too much."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 100_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = WordHash()


def shingle_sets(texts, k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (None: empty)."""
    words = [(t or "").encode().lower().split() for t in texts]
    count = np.array([len(w) for w in words], dtype=np.int64)
    get = _WORDS.__getitem__
    h = np.fromiter((get(w) for ws in words for w in ws), dtype=np.uint64, count=int(count.sum()))
    factor = _odd(k + 1, 20)
    n = len(h) - k + 1
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(k):
        rolled += h[i:i + n] * factor[i] if n > 0 else _U(0)
    rolled = mix64(rolled)
    out, at = [], 0
    for c in count.tolist():
        if c >= k:
            out.append(np.unique(rolled[at:at + c - k + 1]))
        elif c:
            short = (h[at:at + c] * factor[:c]).sum(keepdims=True) + np.array([c], dtype=np.uint64) * factor[k]
            out.append(mix64(short))
        else:
            out.append(np.empty(0, dtype=np.uint64))
        at += c
    return out


def signatures(sets: list[np.ndarray], functions: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of non-empty sets, one row each."""
    out = np.empty((len(sets), len(functions)), dtype=np.uint64)
    first = 0
    while first < len(sets):  # blocks that fit the cache
        last, size = first, 0
        while last < len(sets) and (size == 0 or size + len(sets[last]) <= 32_768):
            size += len(sets[last])
            last += 1
        block = np.concatenate(sets[first:last])
        starts = np.cumsum([0] + [len(s) for s in sets[first:last - 1]])
        product = np.empty_like(block)
        for j, f in enumerate(functions):
            np.multiply(block, f, out=product)
            out[first:last, j] = np.minimum.reduceat(product, starts)
        first = last
    return (out >> _U(32)).astype(np.uint32)


def sign(docs: DataFrame, id_col: str, text_col: str, k: int, trees: int, depth: int, extra: int) -> DataFrame:
    """(id, n, set_key, sig) of every row; sig holds the first ``depth`` values
    of all trees, then their ``extra`` ones."""
    ship(docs.sparkSession)
    functions = _odd(trees * (depth + extra), 40)

    def run(batches):
        import xxhash

        for batch in (part for whole in batches for part in slices(whole, 1, 1_000_000)):
            sets = shingle_sets(batch.column(1).to_pylist(), k)
            full = [s for s in sets if len(s)]
            sigs = iter(signatures(full, functions)) if full else iter(())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([next(sigs).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["id", "n", "set_key", "sig"])
        _WORDS.clear()  # the worker goes on to other stages

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n long, set_key binary, sig binary")


def orders(classes: DataFrame, trees: int, depth: int, extra: int) -> DataFrame:
    """One row per class (id, n, sig, component) and tree: key (the first
    values), path (the ``extra`` ones, big-endian), id, n, the sketch (s0, s1)
    and the component."""
    salt = _odd(trees, 60)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = batch.num_rows
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint32).reshape(m, -1)
            bits = np.packbits((sig[:, :128] & np.uint32(1)).astype(np.uint8), axis=1)
            sketch = np.zeros((m, 16), dtype=np.uint8)
            sketch[:, :bits.shape[1]] = bits
            s = sketch.view(np.int64)
            for t in range(trees):
                key = np.full(m, salt[t], dtype=np.uint64)
                for j in range(depth):
                    key = mix64(key * _U(0x9E3779B97F4A7C15) + sig[:, t * depth + j])
                at = trees * depth + t * extra
                path = np.ascontiguousarray(sig[:, at:at + extra].astype(">u4"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array([r.tobytes() for r in path], pa.binary()),
                     batch.column(0), batch.column(1), pa.array(s[:, 0].copy()), pa.array(s[:, 1].copy()), batch.column(3)],
                    names=["key", "path", "id", "n", "s0", "s1", "component"])

    return classes.select("id", "n", "sig", "component").mapInArrow(
        run, "key long, path binary, id long, n long, s0 long, s1 long, component long")


def alike(a, b, n, s0, s1, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Length filter and sketch filter of row pairs; and the differing bits."""
    low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
    bits = sum(np.bitwise_count((s[a] ^ s[b]).view(np.uint64)).astype(np.int32) for s in (s0, s1))
    return (100 * low >= threshold * high) & (bits <= SKETCH_LIMIT), bits


def region_pairs(levels: np.ndarray, ids, n, s0, s1, region: int, window: int, threshold: int,
                 component=None, best: bool = False, cut=None):
    """Candidates of sorted rows, of different components only. ``levels``
    holds, per row, the values of the key and of each further level. Returns
    (a, b, bits) by id (``best``: for each row the partner of fewest bits
    only) and, for rows of regions that stay large, (row, region hash). Rows
    marked in ``cut`` belong to a large region whose other rows went before."""
    m = len(ids)
    component = ids if component is None else component
    new = np.zeros(m, dtype=bool)
    new[0] = True
    group = np.full(m, -1, dtype=np.int64)
    for level in range(levels.shape[1]):
        new[1:] |= levels[1:, level] != levels[:-1, level]
        start = np.flatnonzero(new)
        size = np.diff(np.r_[start, m])
        number = np.cumsum(new) - 1
        fits = (group < 0) & (size[number] <= region)
        if cut is not None:
            fits &= ~cut
        group[fits] = start[number[fits]]
    big = group < 0
    group[big] = start[number[big]]
    length = np.bincount(group, minlength=m)[group]
    reach = np.where(big, np.minimum(window, length), length)
    found, at = [], np.arange(m)
    fewest, partner = np.full(m, 129, dtype=np.int32), np.full(m, -1, dtype=np.int64)
    for d in range(1, max(region, window + 1)):
        at = at[(reach[at] > d) | (big[at] & (reach[at] >= d))]
        at = at[at + d < m]
        if not len(at):
            break
        i = at[group[at] == group[at + d]]
        i = i[(big[i] == big[i + d]) & (component[i] != component[i + d])]
        ok, bits = alike(i, i + d, n, s0, s1, threshold)
        i, bits = i[ok], bits[ok]
        if not best:
            found.append((i, i + d, bits))
            continue
        for x, y in ((i, i + d), (i + d, i)):  # no row is twice in x
            less = bits < fewest[x]
            fewest[x[less]], partner[x[less]] = bits[less], y[less]
    if best:
        x = np.flatnonzero(partner >= 0)
        found.append((x, partner[x], fewest[x]))
    a = np.concatenate([x[0] for x in found] or [np.empty(0, np.int64)])
    b = np.concatenate([x[1] for x in found] or [np.empty(0, np.int64)])
    bits = np.concatenate([x[2] for x in found] or [np.empty(0, np.int32)])
    low, high = np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])
    rows = np.flatnonzero(big)
    mark = levels[rows, 0].astype(np.int64).view(np.uint64).copy()
    for level in range(1, levels.shape[1]):
        mark = mix64(mark * _U(0x9E3779B97F4A7C15) + levels[rows, level].astype(np.int64).view(np.uint64))
    return low, high, bits, rows, mark.view(np.int64)


CANDIDATES = "a long, b long, bits int, region long"


def candidates(sorted_rows: DataFrame, region: int, window: int, threshold: int, best: bool = False,
               hold: int = 500_000) -> DataFrame:
    """Pairs (a < b, bits) and, with ``b`` null, members of large regions."""

    def run(batches):
        held: list = []
        parted = None  # the levels of a deepest region that was cut, as long as more of it may come

        def emit(t, upto):
            ids, n, s0, s1, component = (t[i][:upto] for i in (1, 2, 3, 4, 5))
            cut = None if parted is None else (t[0][:upto] == parted).all(axis=1)
            if len(ids) < 2 and cut is None:
                return None
            a, b, bits, rows, mark = region_pairs(t[0][:upto], ids, n, s0, s1, region, window, threshold, component, best, cut)
            pairs, big = len(a), len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.r_[a, ids[rows]]), pa.concat_arrays([pa.array(b), pa.nulls(big, pa.int64())]),
                 pa.concat_arrays([pa.array(bits.astype(np.int32)), pa.nulls(big, pa.int32())]),
                 pa.concat_arrays([pa.nulls(pairs, pa.int64()), pa.array(mark)])], names=["a", "b", "bits", "region"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            path = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=">u4").reshape(batch.num_rows, -1)
            t = [np.column_stack([key, path.astype(np.int64)])] + [batch.column(i).to_numpy() for i in (2, 3, 4, 5, 6)]
            held = [np.concatenate(x) for x in zip(held, t)] if held else t
            levels = held[0]
            # everything before the last key is complete; a very long run is
            # cut at its coarsest boundary, or within its deepest region
            cut, keep = 0, 0
            for level in range(levels.shape[1]):
                differs = np.flatnonzero((levels[1:, :level + 1] != levels[:-1, :level + 1]).any(axis=1))
                if len(differs):
                    cut = int(differs[-1]) + 1
                    break
                if len(levels) <= hold:
                    break
            else:
                cut, keep = len(levels), window
            if level and len(levels) <= hold:
                cut = 0
            if cut:
                out = emit(held, cut)
                parted = levels[-1].copy() if keep else None
                held = [x[cut - keep:] for x in held]
                if out is not None:
                    yield out
        if held:
            out = emit(held, len(held[1]))
            if out is not None:
                yield out

    return sorted_rows.mapInArrow(run, CANDIDATES)


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ok = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(100 * both >= threshold * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    named = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = small_join(sets, named, "id", "left_semi", limit=IDS)
    one = sets.select(F.col("id").alias("a"), F.col("set").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    return (pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 80,
                    trees: int = 32, depth: int = 4, extra: int = 4, region: int = 64, window: int = 8,
                    rounds: int = 2, block: int = 1024) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per row of ``docs``."""
    spark = docs.sparkSession
    signed = stored(sign(docs, id_col, text_col, k, trees, depth, extra), "signed")
    classes = (signed.filter("n > 0 AND id IS NOT NULL").groupBy("set_key")
               .agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    classes = stored(classes, "classes")

    links, live, sets, members = None, classes, None, None
    label = spark.createDataFrame([], "node long, component long")
    for step in range(rounds + 1):
        last = step == rounds
        # ids that repeat hold several sets: classes, not ids, are compared
        named = live.withColumn("component", F.col("id"))
        if links is not None:
            named = small_join(live, label.withColumnRenamed("node", "id"), "id", "left", limit=IDS)
            named = named.withColumn("component", F.coalesce("component", "id"))
        rows = orders(named, trees, depth, extra).repartition("key").sortWithinPartitions("key", "path", "id")
        found = stored(candidates(rows, region, window, threshold, best=not last), "candidates")
        pairs = stored(found.filter("b IS NOT NULL AND a < b").groupBy("a", "b").agg(F.min("bits").alias("bits")), "pairs")
        n_pairs = pairs.count()
        needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
        if step == 0:
            members = found.filter("b IS NULL").select(F.col("a").alias("id"), "region")
            needed = stored(needed.union(members.select("id")).distinct(), "needed")
            sets = stored(small_join(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")),
                                     needed, "id", limit=IDS).transform(lambda d: _sets(d, k)), "sets")
        if not n_pairs:
            break
        now = pairs.select("a", "b")
        if not last:
            both = pairs.select(F.col("a").alias("x"), "a", "b", "bits").union(pairs.select("b", "a", "b", "bits"))
            now = both.groupBy("x").agg(F.min(F.struct("bits", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
        now = stored(now, "now", n_pairs)
        links, label = _join_links(links, confirmed(now, sets, threshold))
        if not last:
            # a class without a partner in another component has none later
            needed = needed.union(members.select("id")).distinct()
            live = stored(small_join(classes, needed, "id", "left_semi", limit=IDS), "live")

    if members.limit(1).count():
        links, label = _join_links(links, _large_regions(members, label, sets, threshold, block))

    heads = classes.select("set_key", F.col("id").alias("head"))
    out = signed.select("id", "n", "set_key").join(heads, "set_key", "left")
    # an id with several sets joins their classes
    several = out.filter("head <> id").select(F.col("id").alias("a"), F.col("head").alias("b"))
    repeated = (signed.filter("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.countDistinct("set_key").alias("c")).filter("c > 1"))
    if repeated.limit(1).count():
        links, label = _join_links(links, several)
    out = out.withColumn("__node", F.coalesce("head", "id"))
    out = out.join(label.withColumnRenamed("node", "__node"), "__node", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component", "head", "id"))
    return out.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, 1, 1_000_000)):
            sets = shingle_sets(batch.column(1).to_pylist(), k)
            full = pa.array([len(s) > 0 for s in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(full), pa.array([s.tobytes() for s in sets if len(s)], pa.binary())], names=["id", "set"])
        _WORDS.clear()

    return docs.mapInArrow(run, "id long, set binary")


def _join_links(links, more: DataFrame):
    """All links so far with the new ones, and the components they make."""
    more = stored(more.select("a", "b"), "links")
    links = more if links is None else links.union(more)
    n = links.count()
    links = stored(links, "links", n)
    return links, components(links, n)


def _large_regions(members: DataFrame, label: DataFrame, sets: DataFrame, threshold: int, block: int) -> DataFrame:
    """Links of the regions that stayed large: every member outside the largest
    component of its cluster (regions that share members) against every member
    of another component. Both sides are cut into blocks of about ``block``
    sets; a task holds one block of each and returns links only."""
    n = members.count()
    members = stored(members.distinct(), "members", n)
    # a member links its first region with its others: few links, as a region has many members
    first = F.min("region").over(Window.partitionBy("id"))
    regions = stored(members.select(first.alias("a"), F.col("region").alias("b")).distinct(), "regions", n)
    cluster = components(regions).select("node", F.col("component").alias("cluster"))
    named = members.groupBy("id").agg(F.min("region").alias("node")).join(cluster, "node").select("id", "cluster")
    named = named.join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id"))
    sizes = named.groupBy("cluster", "c").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("m", "c")).alias("t"), F.sum("m").alias("all"))
    largest = largest.select("cluster", F.col("t.c").alias("top"), F.expr(f"CAST(ceil(all / {block}) AS INT)").alias("right"),
                             F.expr(f"CAST(ceil((all - t.m) / {block}) AS INT)").alias("left"))
    named = stored(small_join(sets, named.join(largest, "cluster").filter("left > 0"), "id")
                   .select("cluster", "id", "c", "top", "left", "right", "set"), "clusters", n, 5_000)
    mine = named.filter("c <> top").select(
        "cluster", F.expr("CAST(pmod(xxhash64(id, 1), left) AS INT)").alias("i"),
        F.explode(F.expr("sequence(0, right - 1)")).alias("j"), "id", "c", "set")
    other = named.select("cluster", F.explode(F.expr("sequence(0, left - 1)")).alias("i"),
                         F.expr("CAST(pmod(xxhash64(id, 2), right) AS INT)").alias("j"), "id", "c", "set")

    def compare(x, y):
        return block_links(x, y, threshold)

    keys = ["cluster", "i", "j"]
    return mine.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInPandas(compare, "a long, b long").distinct()


def block_links(x, y, threshold: int):
    """Links between two blocks of full sets (pandas frames id, c, set) of
    different components: those that join what the block's earlier ones left apart."""
    import pandas as pd

    above: dict = {}

    def top(c):
        while c in above:
            above[c] = c = above.get(above[c], above[c])
        return c

    right = [np.frombuffer(s, np.uint64) for s in y["set"]]
    size = np.array([len(s) for s in right], dtype=np.int64)
    if not len(x) or not len(right):
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    values, owner = np.concatenate(right), np.repeat(np.arange(len(right)), size)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    ids, comps, found = y["id"].to_numpy(), y["c"].to_numpy(), []
    for i, c, s in zip(x["id"], x["c"], x["set"]):
        s = np.frombuffer(s, np.uint64)
        low, high = np.searchsorted(values, s, "left"), np.searchsorted(values, s, "right")
        count = high - low
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        both = np.bincount(owner[at], minlength=len(right))
        ok = (100 * both >= threshold * (len(s) + size - both)) & (comps != c)
        _, at = np.unique(comps[ok], return_index=True)
        for d, e in zip(ids[ok][at].tolist(), comps[ok][at].tolist()):
            if top(c) != top(e):
                above[top(e)] = top(c)
                found.append((min(i, d), max(i, d)))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
