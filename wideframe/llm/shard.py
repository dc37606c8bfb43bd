"""Sharding (operator 9): proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash, ranked there, and
ordered over all sources by fractional rank ``(rank + 0.5) / n``: any stretch
of that order holds every source in proportion. The order is cut into
``n_shards`` equal stretches, so counts differ by at most one and each shard
matches the mixture. Law: ``rows``.

Scale: both rankings use sliced windows (see ``running_total``); a source that
holds a third of all rows is spread over many tasks. Pass only the columns you
need: they are shuffled twice.

Defined cases: a null source is a source; null or repeated ids are ordered by
the remaining order columns, and rows alike in all of them are
interchangeable. An empty table gives no rows. Output columns replace columns
of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bins_for, group_key, running_total, uniform_sql


def interleave_shards(docs: DataFrame, n_shards: int, order_cols=("doc_id",), source_col: str = "source",
                      seed: int = 11) -> DataFrame:
    """``docs`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0
    within the shard, in the interleaved order). ``order_cols`` tell rows of a
    source apart; they seed the shuffle and break ties."""
    key = "concat_ws('|', " + ", ".join(f"coalesce(CAST(`{c}` AS STRING), '')" for c in order_cols) + ")"
    base = docs.drop("shard", "slot").withColumns({
        "__g": F.expr(group_key(source_col)), "__one": F.lit(1).cast("long"), "__k": F.expr(key)})
    base = base.withColumn("__u", F.expr(uniform_sql(seed, "__k")))
    counts = base.groupBy("__g").agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    bins = bins_for(total)
    ranked = running_total(base, ["__g"], "__u", ["__u", "__k"], "__one", "__rank", bins)
    ranked = ranked.join(counts, "__g").withColumn("__f", F.expr("(__rank + 0.5D) / __n"))
    placed = running_total(ranked, [], "__f", ["__f", "__g", "__rank"], "__one", "__pos", bins)
    # shard s holds positions ceil(s * total / n) up to ceil((s + 1) * total / n)
    shard = f"CAST(__pos * {n_shards} DIV {max(total, 1)} AS INT)"
    placed = placed.withColumn("shard", F.expr(shard))
    start = f"(CAST(shard AS BIGINT) * {total} + {n_shards - 1}) DIV {n_shards}"
    return (placed.withColumn("slot", F.expr(f"__pos - {start}"))
            .drop("__g", "__one", "__k", "__u", "__rank", "__n", "__f", "__pos"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; its files hold consecutive slots in order. Ranges
    of (shard, slot), so a large shard is written by many tasks."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
