"""Line dedup (operator 5): exact set-similarity join over all lines.

A line is the set of its lower-cased words. Lines of at least ``min_tokens``
distinct words take part; a line is removed when an earlier line (by document
id, then line number) has a Jaccard similarity of ``threshold`` percent or
more. Earlier lines count whether or not they are removed themselves, so the
result does not depend on the order of work. With ``min_tokens=1`` every line
with words takes part (below four words a match at 80 percent is an equal set).

Method: words are ordered by rarity (a count over all lines, kept as a small
number for each of ``2**bits`` hash buckets, so the table has a fixed size; any
total order gives right results, a good one gives few candidates). Lines with
equal sets are one class with one first place. The rarest words of a class
(prefix filter) are joined by word under the length, the positional and the
bitmap filter (sets whose maps of 64 or 128 places differ in more places than
the sets may differ in words cannot match). A class
only needs one earlier witness: classes without any possible partner are
dropped by a semi join, the others are compared with the 8 earliest members of
each of their word groups, those without a witness with the next 64, then 512
and so on, until every member has been compared or has a witness. A group of
thousands of near copies therefore costs a few comparisons per line instead of
all pairs, and no pair that could matter is skipped. Candidates are confirmed
on the full sets of 64-bit word hashes.

DataFrame functions only. Scale: three scans of the texts; shuffles carry
hashes; full sets are built only for lines with candidates.

Defined cases: null text has no lines; shorter lines and lines of documents
with a null id stay as they are; rows that repeat an id are one document if
their texts are equal, and with different texts each loses its own lines (a
place carries a hash of its line); an empty table gives no rows. A document that
loses every line keeps an empty text. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_join, stored

BITS = 16

#: Lines of more words get a bitmap of 128 places instead of 64.
LONG = 48


def cut(text: str) -> str:
    """SQL for the lower-cased words of a text without line ends, with empty
    strings between them: a split at a plain space is cheaper than at a pattern."""
    plain = f"translate(lower({text}), '\t\u000B\f\r', '    ')"
    return f"split(IF({text} RLIKE '[\\\\x09\\\\x0B-\\\\x0D]', {plain}, lower({text})), ' ')"


def line_hashes(line: str) -> str:
    """SQL for the hashes of the distinct lower-cased words of a line."""
    return f"array_remove(array_distinct(transform({cut(line)}, w -> xxhash64(w))), xxhash64(''))"


def exploded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, line_no, line), line numbers from 0."""
    return (docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line")))


def rarity_list(texts: DataFrame, bits: int = BITS) -> str:
    """One number per hash bucket, joined by commas: three times the binary
    logarithm of the number of words in it. ``2**bits`` rows at most reach the
    driver. ``texts`` has the column text."""
    import numpy as np

    words = texts.select(F.explode(F.expr(cut("replace(text, '\\n', ' ')"))).alias("w")).filter("w <> ''")
    counts = words.groupBy(F.expr(f"CAST(xxhash64(w) & {2 ** bits - 1} AS INT)").alias("b")).count().toPandas()
    table = np.zeros(2 ** bits)
    table[counts["b"].to_numpy(dtype=int)] = counts["count"].to_numpy(dtype=float)
    return ",".join(map(str, np.minimum(127, np.rint(3 * np.log2(table + 1))).astype(int).tolist()))


def ordered_keys(line: str, rarity: str, bits: int = BITS) -> str:
    """SQL for the sorted keys of a line's distinct words: 7 bits of rarity,
    then 56 bits of hash. The rarity table folds into one array literal."""
    table = f"CAST(split('{rarity}', ',') AS ARRAY<BIGINT>)"
    return (f"sort_array(transform({line_hashes(line)}, h -> "
            f"shiftleft({table}[CAST(h & {2 ** bits - 1} AS INT)], 56) | (h & {2 ** 56 - 1}L)))")


def _places(keys: str) -> str:
    """SQL for a map of 64 places in which those of the keys are set."""
    return f"aggregate({keys}, 0L, (a, x) -> a | shiftleft(1L, CAST(x & 63 AS INT)))"


def similar_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, line_no, n_tokens) of the lines to remove."""
    return _removed(docs, id_col, text_col, **options).select("doc_id", "line_no", "n_tokens").distinct()


def _removed(docs: DataFrame, id_col: str, text_col: str, threshold: int = 80, min_tokens: int = 5,
             first_block: int = 8) -> DataFrame:
    """(doc_id, line_no, line_hash, n_tokens) of the lines to remove."""
    lines = exploded(docs, id_col, text_col)
    texts = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    # the explode of one array keeps the filter from being pushed below the keys, which would work them out twice
    keyed = lines.select("doc_id", "line_no", F.expr("xxhash64(line)").alias("line_hash"),
                         F.explode(F.array(F.expr(ordered_keys("line", rarity_list(texts))))).alias("k"))
    prefix = f"size(k) - ({threshold} * size(k) + 99) DIV 100 + 1"
    placed = keyed.filter(f"size(k) >= {min_tokens}").select(
        "doc_id", "line_no", "line_hash", F.expr("xxhash64(k)").alias("cls"), F.size("k").alias("n"),
        # a word has one place of 64, in long lines of 128 (``more`` holds the second half)
        F.expr(f"IF(size(k) > {LONG}, {_places('filter(k, x -> x & 64 = 0)')}, {_places('k')})").alias("bits"),
        F.expr(f"IF(size(k) > {LONG}, {_places('filter(k, x -> x & 64 <> 0)')}, 0L)").alias("more"),
        F.expr(f"slice(k, 1, CAST({prefix} AS INT))").alias("prefix"))
    placed = stored(placed, "lines")
    firsts = stored(placed.groupBy("cls").agg(F.min(F.struct("doc_id", "line_no", "line_hash")).alias("first")), "firsts")

    # one row per class and rare word; both sides of the semi join read the same exchange
    # (lines of fewer words than this match equal sets only)
    classes = (placed.filter(f"{100 - threshold} * n >= {threshold}").groupBy("cls")
               .agg(*(F.first(c).alias(c) for c in ("n", "bits", "more", "prefix"))))
    entries = classes.select("cls", "n", "bits", "more", F.posexplode("prefix").alias("pos", "tok"))
    x, y = entries.alias("x"), entries.alias("y")
    differ = (f"IF((x.n > {LONG}) = (y.n > {LONG}), bit_count(x.bits ^ y.bits) + bit_count(x.more ^ y.more), "
              f"bit_count((x.bits | x.more) ^ (y.bits | y.more)))")
    # whole numbers without divisions: the condition is worked out for every two rows of a word
    meet = (f"{100 + threshold} * least(x.n - x.pos, y.n - y.pos) >= {threshold} * (x.n + y.n) AND "
            f"{100 + threshold} * {differ} <= {100 - threshold} * (x.n + y.n) AND "
            f"100 * x.n >= {threshold} * y.n AND 100 * y.n >= {threshold} * x.n")
    able = x.join(y, F.expr(f"x.tok = y.tok AND x.cls <> y.cls AND {meet}"), "left_semi")
    able = able.join(firsts, "cls")
    turn = Window.partitionBy("tok").orderBy("first", "cls")
    able = stored(able.withColumn("rn", F.row_number().over(turn)), "entries")

    involved = stored(able.select("cls").distinct().join(firsts, "cls").select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.line_no").alias("line_no"), F.col("first.line_hash").alias("line_hash"), "cls"), "involved")
    wanted = involved.groupBy("doc_id").agg(F.collect_list(F.struct("line_no", "line_hash", "cls")).alias("want"))
    again = small_join(docs.select(F.col(id_col).alias("doc_id"), F.split(F.col(text_col), "\n").alias("ls")), wanted, "doc_id",
                       limit=500_000)
    words = (again.select(F.inline(F.expr("transform(want, w -> named_struct('cls', w.cls, 'line_hash', w.line_hash, 'line', get(ls, w.line_no)))")))
             .filter("line IS NOT NULL AND xxhash64(line) = line_hash")
             .select("cls", F.expr(line_hashes("line")).alias("ws")).dropDuplicates(["cls"]))
    words = stored(words, "words")

    last = able.agg(F.max("rn")).first()[0] or 0
    low, size, asking, matched = 0, first_block, able, None
    while low < last:
        index = able.filter(f"rn > {low} AND rn <= {low + size}").alias("y")
        pairs = (asking.alias("x").join(index, F.expr(f"x.tok = y.tok AND x.rn > y.rn AND {meet}"))
                 .select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
        a = words.select(F.col("cls").alias("a"), F.col("ws").alias("wa"))
        b = words.select(F.col("cls").alias("b"), F.col("ws").alias("wb"))
        hit = (pairs.join(a, "a").join(b, "b").withColumn("both", F.expr("size(array_intersect(wa, wb))"))
               .filter(f"100 * both >= {threshold} * (size(wa) + size(wb) - both)").select(F.col("a").alias("cls")).distinct())
        hit = stored(hit, "matched")
        matched = hit if matched is None else matched.union(hit)
        low, size = low + size, size * 8
        if low < last:
            asking = stored(asking.filter(f"rn > {low}").join(hit, "cls", "left_anti"), "asking")
    if matched is None:
        matched = able.select("cls").limit(0)
    state = firsts.join(matched.withColumn("hit", F.lit(True)), "cls", "left")
    # every later place of a class goes, and its first one if there is a witness
    out = placed.select("doc_id", "line_no", "line_hash", "n", "cls").join(state, "cls").filter(
        "hit OR doc_id <> first.doc_id OR line_no <> first.line_no")
    return out.select("doc_id", "line_no", "line_hash", F.col("n").alias("n_tokens")).distinct()


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the removed lines; same columns."""
    gone = _removed(docs, id_col, text_col, **options)
    gone = stored(gone.groupBy(F.col("doc_id").alias(id_col))
                  .agg(F.collect_set(F.struct("line_no", "line_hash")).alias("__gone")), "gone")
    text = (f"IF(__gone IS NULL, `{text_col}`, array_join(filter(split(`{text_col}`, '\\n'), "
            "(l, i) -> NOT array_contains(__gone, named_struct('line_no', i, 'line_hash', xxhash64(l)))), '\\n'))")
    return small_join(docs, gone, id_col, "left").withColumn(text_col, F.expr(text)).select(*docs.columns)
