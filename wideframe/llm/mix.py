"""Mixing sources to target weights (operator 1): Pareto order sampling.

Every source gets a target number of words. The target is ``q`` whole passes
over the source plus a remainder: each document gets ``q`` certain copies, and
one more copy is drawn with unequal inclusion probabilities. A document's
probability is proportional to its size raised to ``size_power``; documents
whose probability reaches 1 are certain. The others are ranked by
``[u / (1 - u)] / [p / (1 - p)]`` (random odds over inclusion odds) and taken
in that order until the remainder is filled: a sample of fixed size, measured
in words, that ends within half a document of the target.

Scale: sizes are stored once as a narrow table; ranks and running totals come
from sliced windows (no task holds a source), and only one row per source
reaches the driver, where it becomes a cut that the final pass over the
documents applies. Texts are never shuffled.

Defined cases: null text has size 0; documents of size 0 get the certain
copies only. A null source is a source of its own and sorts last. Rows that
repeat an id within a source share one draw. An empty table gives no rows.
Output columns replace columns of the same name.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bins_for, group_key, running_total, small_join, stored, uniform_sql

MAX_REPEATS = 3


def targets(sizes: dict, weights: dict, total, max_repeats: int = MAX_REPEATS) -> dict:
    """Target per source as a fraction: ``total`` shared by weight, each target
    at most ``max_repeats`` times its source's size, the excess shared again by
    weight among the others until none is above."""
    out, open_ = {}, {s for s in sizes if weights[s] > 0}
    out.update({s: Fraction(0) for s in sizes if s not in open_})
    left = Fraction(total)
    while open_:
        share = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if share * weights[s] >= max_repeats * sizes[s]}
        if not full:
            out.update({s: share * weights[s] for s in open_})
            break
        for s in full:
            out[s] = Fraction(max_repeats * sizes[s])
            left -= out[s]
        open_ -= full
    return out


def cycled_weights(sources, pattern=(5, 2, 1)) -> dict:
    """The pattern repeated over the sources by code point, null last."""
    ordered = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: pattern[i % len(pattern)] for i, s in enumerate(ordered)}


def pareto_mix(docs: DataFrame, size_col: str, weights=cycled_weights, share: float = 1.0, id_col: str = "doc_id",
               source_col: str = "source", max_repeats: int = MAX_REPEATS, seed: int = 7,
               size_power: float = 0.5) -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``copies`` and ``taken``.

    ``weights`` is a dict by source or a function of the sources; ``share`` is
    the mix's size as a share of all sizes. The number of sources must fit the
    driver (it is a configuration, not data)."""
    spark = docs.sparkSession
    narrow = docs.select(F.expr(group_key(source_col)).alias("__g"), F.col(source_col).alias("__s"),
                         F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__id"),
                         F.col(size_col).cast("long").alias("__size"))
    narrow = narrow.withColumns({
        "__u": F.expr(uniform_sql(seed, "__id")),
        "__x": F.expr(f"CAST(greatest(floor(1024 * power(__size, {float(size_power)}D)), 1) AS BIGINT)")})
    narrow = stored(narrow, "mix")
    rows = narrow.groupBy("__g").agg(F.first("__s").alias("s"), F.sum("__size").alias("size"),
                                     F.count("*").alias("n")).collect()
    size_of = {r["s"]: r["size"] for r in rows}
    key_of = {r["s"]: r["__g"] for r in rows}
    total = sum(size_of.values())
    weight_of = weights(list(size_of)) if callable(weights) else {s: weights.get(s, 0) for s in size_of}
    target_of = targets(size_of, weight_of, Fraction(share) * total, max_repeats)

    plan = []
    for s, size in size_of.items():
        ratio = target_of[s] / size if size else Fraction(0)
        whole = int(ratio)
        plan.append({"g": key_of[s], "size": size, "target": float(target_of[s]), "whole": whole,
                     "rest": round(target_of[s] - whole * size)})
    scale = _scales(narrow, plan)
    cuts = _cuts(narrow, plan, scale, sum(r["n"] for r in rows))
    schema = ("__g string, source_size long, target double, __whole int, __scale double, "
              "__cq double, __cid string, __csize long")
    table = spark.createDataFrame(
        [(p["g"], p["size"], p["target"], p["whole"], scale.get(p["g"]), *cuts.get(p["g"], (None, None, None)))
         for p in plan], schema)

    out = docs.drop("source_size", "target", "copies", "taken").withColumns({
        "__g": F.expr(group_key(source_col)),
        "__id": F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        "__size": F.col(size_col).cast("long")})
    out = out.withColumns({
        "__u": F.expr(uniform_sql(seed, "__id")),
        "__x": F.expr(f"CAST(greatest(floor(1024 * power(__size, {float(size_power)}D)), 1) AS BIGINT)")})
    out = small_join(out, table, "__g")
    drawn = ("__size > 0 AND __scale IS NOT NULL AND (__scale * __x >= 1D OR "
             f"(__cq IS NOT NULL AND struct({ODDS}, __id, __size) <= struct(__cq, __cid, __csize)))")
    out = out.withColumn("copies", F.expr(f"__whole + IF({drawn}, 1, 0)"))
    return (out.withColumn("taken", F.expr("copies * __size"))
            .drop("__g", "__id", "__size", "__u", "__x", "__whole", "__scale", "__cq", "__cid", "__csize"))


#: Random odds over inclusion odds of a document with probability __scale * __x < 1.
ODDS = "(__u / (1D - __u)) / ((__scale * __x) / (1D - __scale * __x))"


def _scales(narrow: DataFrame, plan) -> dict:
    """Per source the factor c with sum(min(1, c * x) * size) = rest. Each
    round fixes the documents that became certain and solves for the others;
    the set only grows, and a round is one aggregate of a few rows."""
    rest = {p["g"]: p["rest"] for p in plan if p["rest"] > 0}
    scale: dict = {}
    certain = {g: -1 for g in rest}
    while rest:
        when = _per_source(scale, "CAST(NULL AS DOUBLE)")
        got = (narrow.filter("__size > 0").withColumn("__c", F.expr(when))
               .withColumn("__one", F.expr("coalesce(__c * __x >= 1D, false)"))
               .groupBy("__g").agg(F.expr("sum(IF(__one, 1, 0))").alias("n"),
                                   F.expr("sum(IF(__one, __size, 0))").alias("fixed"),
                                   F.expr("CAST(sum(IF(__one, 0, CAST(__x AS DECIMAL(38, 0)) * __size)) AS STRING)").alias("xs")).collect())
        moved = False
        for r in got:
            g = r["__g"]
            if g in rest and r["n"] > certain[g]:
                certain[g], moved = r["n"], True
                xs = int(r["xs"])
                if xs:
                    scale[g] = float(Fraction(max(0, rest[g] - r["fixed"]), xs))
        if not moved:
            break
    return scale


def _per_source(values: dict, default: str) -> str:
    """SQL that looks a number up by source key; a map literal, one entry a source."""
    if not values:
        return default
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    entries = ", ".join(f"{quote(k)}, CAST('{v!r}' AS DOUBLE)" for k, v in values.items())
    return f"map({entries})[__g]"


def _cuts(narrow: DataFrame, plan, scale: dict, n: int) -> dict:
    """Per source the last document taken in rank order: ranks run until the
    remainder is filled, with half of the crossing document as tolerance."""
    rest = {p["g"]: float(p["rest"]) for p in plan if p["g"] in scale}
    if not rest:
        return {}
    ranked = (narrow.withColumn("__scale", F.expr(_per_source(scale, "NULL")))
              .withColumn("__rest", F.expr(_per_source(rest, "NULL")))
              .filter("__size > 0 AND __scale IS NOT NULL"))
    certain = {r["__g"]: r["t"] for r in ranked.filter("__scale * __x >= 1D").groupBy("__g")
               .agg(F.sum("__size").alias("t")).collect()}
    open_ = (ranked.filter("__scale * __x < 1D").withColumn("__q", F.expr(ODDS))
             .withColumn("__unit", F.expr("__q / (1D + __q)"))
             .withColumn("__left", F.expr("__rest - " + (f"coalesce({_per_source({k: float(v) for k, v in certain.items()}, 'NULL')}, 0D)"
                                                          if certain else "0D"))))
    run = running_total(open_, ["__g"], "__unit", ["__q", "__id", "__size"], "__size", "__before", bins_for(n))
    last = (run.filter("__before + __size / 2D <= __left")
            .groupBy("__g").agg(F.max(F.struct("__q", "__id", "__size")).alias("c")).collect())
    return {r["__g"]: (r["c"]["__q"], r["c"]["__id"], r["c"]["__size"]) for r in last}
