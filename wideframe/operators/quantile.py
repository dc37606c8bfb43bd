"""Exact, linearly interpolated quantiles (pandas ``quantile`` semantics, N6).

One plan for every size: values are pre-aggregated to distinct ``(column,
value, weight)`` (map-side combine, so a value holding a third of all rows is
one row), range-partitioned (sampled bounds → bounded partitions) and
checkpointed to the shared checkpoint folder; per-(partition, column) totals (a
small table) give rank offsets; one ``mapInPandas`` scan then emits only the
rows at the wanted ranks. No task holds a column; the driver sees partitions ×
columns totals and columns × probabilities values.

``method="approx"`` is ``percentile_approx`` with an accuracy knob (not exact).
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

APPROX_ACCURACY = 100_000


def _c(name):
    return F.col("`" + name.replace("`", "``") + "`")


_RANK_SCHEMA = StructType([StructField("c", IntegerType()), StructField("rank", LongType()),
                           StructField("v", DoubleType())])


def _distributed_values(df: DataFrame, cols, probs, partitions: int | None = None) -> dict:
    from ..session import cut_lineage, shuffle_partitions

    spark = df.sparkSession
    if partitions is None:
        partitions = shuffle_partitions(spark)
    structs = [F.struct(F.lit(i).alias("c"), _c(c).cast("double").alias("v")) for i, c in enumerate(cols)]
    longf = (df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
             .filter(F.col("v").isNotNull() & ~F.isnan("v")))
    distinct = longf.groupBy("c", "v").agg(F.count(F.lit(1)).alias("w"))
    ranged = (distinct.repartitionByRange(partitions, "c", "v")
              .withColumn("pid", F.spark_partition_id())
              .sortWithinPartitions("c", "v"))
    ranged = cut_lineage(ranged)

    # per (partition, column) weight — at most partitions × columns rows
    tot = ranged.groupBy("pid", "c").agg(F.sum("w").alias("tot")).collect()
    by_col: dict[int, list] = {}
    for r in tot:
        by_col.setdefault(r["c"], []).append((r["pid"], r["tot"]))
    offsets, n_of = {}, {}
    for c, lst in by_col.items():
        run = 0
        for pid, t in sorted(lst):
            offsets[(pid, c)] = run
            run += t
        n_of[c] = run
    wanted = {}
    for c, n in n_of.items():
        ranks = set()
        for p in probs:
            pos = (n - 1) * p
            ranks.add(int(math.floor(pos)))
            ranks.add(int(math.ceil(pos)))
        wanted[c] = sorted(ranks)

    bc = spark.sparkContext.broadcast((offsets, wanted))

    def pick(batches):
        offs, want = bc.value
        running = {}
        for pdf in batches:
            if pdf.empty:
                continue
            out = []
            for (pid, c), g in pdf.groupby(["pid", "c"], sort=False):
                key = (int(pid), int(c))
                start = running.get(key, offs.get(key, 0))
                cum = start + g["w"].cumsum().to_numpy()
                lo = cum - g["w"].to_numpy()
                vals = g["v"].to_numpy()
                for rk in want.get(int(c), ()):
                    if start <= rk < cum[-1]:
                        idx = int((cum > rk).argmax())
                        if lo[idx] <= rk:
                            out.append((int(c), rk, float(vals[idx])))
                running[key] = int(cum[-1])
            if out:
                yield pd.DataFrame(out, columns=["c", "rank", "v"])

    picked = ranged.select("pid", "c", "v", "w").mapInPandas(pick, _RANK_SCHEMA).collect()
    at = {(r["c"], r["rank"]): r["v"] for r in picked}
    result = {}
    for i, c in enumerate(cols):
        n = n_of.get(i, 0)
        vals = []
        for p in probs:
            if n == 0:
                vals.append(None)
                continue
            pos = (n - 1) * p
            lo, hi = int(math.floor(pos)), int(math.ceil(pos))
            a, b = at[(i, lo)], at[(i, hi)]
            vals.append(a if lo == hi else (hi - pos) * a + (pos - lo) * b)
        result[c] = vals
    return result


def quantile_values(df: DataFrame, cols, probs, method: str = "exact") -> dict:
    """Quantiles as ``{column: [value per prob]}`` (None for an empty column)."""
    cols, probs = list(cols), list(probs)
    if not cols:
        return {}
    if method == "exact":
        return _distributed_values(df, cols, probs)
    if method == "approx":
        row = df.agg(*[F.percentile_approx(_c(c).cast("double"), probs, APPROX_ACCURACY).alias(f"__p{i}")
                       for i, c in enumerate(cols)]).first()
        return {c: [None] * len(probs) if row[f"__p{i}"] is None else list(row[f"__p{i}"]) for i, c in enumerate(cols)}
    raise ValueError(method)


def medians(df: DataFrame, cols, method: str = "exact") -> dict:
    return {c: v[0] for c, v in quantile_values(df, cols, [0.5], method=method).items()}
