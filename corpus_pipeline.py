"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing to target
weights, packing. Every stage takes and returns documents; the last returns
packed pieces.

A stage gets (spark, docs, sf_dir) and works on all rows it is given. The
stages' own docstrings (``wideframe/llm``) define nulls, empty texts, repeated
rows and empty tables. Rows are told apart by ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wideframe.llm.common import n_words_sql, small_join, stored
from wideframe.llm.forest import near_duplicates
from wideframe.llm.linedup import dedup_lines
from wideframe.llm.mix import pareto_mix
from wideframe.llm.pack import pack
from wideframe.llm.quality import judge
from wideframe.sources.tables import read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rule table."""
    judged = judge(docs.select("doc_id", "text", F.struct(*docs.columns).alias("__row")))
    return judged.filter("kept").select("__row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines, short ones too, that an earlier line
    matches; ``n_chars``, where the documents have it, follows the text."""
    out = dedup_lines(docs, min_tokens=1)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.expr("CAST(char_length(text) AS BIGINT)"))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group of near copies (five-word
    shingles, similarity 0.8). Rows with a null id stay; of rows that share an
    id and the text the one with the smallest other columns stays, rows that
    share an id only all stay."""
    found = near_duplicates(docs)
    gone = found.filter("NOT kept").select(F.col("id").alias("doc_id")).distinct()
    left = small_join(docs, gone, "doc_id", "left_anti")
    named = left.filter("doc_id IS NOT NULL")
    if not named.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        return left
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = named.groupBy("doc_id", "text").agg(F.min(F.struct(*rest, F.lit(0).alias("__0"))).alias("__rest"))
    one = one.select("doc_id", "text", "__rest.*").select(*docs.columns)
    return one.union(left.filter("doc_id IS NULL").select(*docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (taken twice: two rows);
    documents without words are not in it."""
    sized = docs.select("doc_id", "source", F.expr(n_words_sql("text")).alias("__words"), F.struct(*docs.columns).alias("__row"))
    mixed = pareto_mix(sized, "__words").filter("taken > 0")
    return mixed.select("__row", F.explode(F.sequence(F.lit(1), "copies"))).select("__row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of 2048 ids."""
    return pack(docs).select("doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset",
                             F.crc32("ids").alias("ids_crc32"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-dedup", near_dedup), ("mix", mix), ("packing", packing)]

#: Token ids and the near-dedup's components are not SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
