"""Registered queries of the numbered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import n_words_sql, stored
from .fim import digests, framed, transformed
from .forest import near_duplicates
from .lexical import search
from .linedup import similar_lines
from .lm import score_documents
from .mix import pareto_mix
from .order import materialise
from .pack import pack
from .partenum import similar_documents
from .quality import judge
from .shard import interleave_shards
from .topk import top_k
from .urls import filter_urls

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", F.expr(n_words_sql("text")).alias("size"))
    return pareto_mix(sized, "size").select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


@query
def op9_interleave_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.expr("CAST(octet_length(coalesce(text, '')) + 1 AS BIGINT)").alias("size"),
        F.expr("crc32(CAST(coalesce(text, '') AS BINARY))").alias("text_crc32"))
    placed = interleave_shards(docs, 8, ("doc_id", "text_crc32", "size"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_deficit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialise(read_table(spark, sf_dir, "documents")).drop("path")


@query
def op3_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


@query
def op6_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), k=4)
    return found.withColumnRenamed("id", "doc_id")


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_lines(read_table(spark, sf_dir, "documents"), min_tokens=1)


@query
def op2_log_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op12_compressed_frames_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = stored(framed(read_table(spark, sf_dir, "documents")), "frames")
    return digests(transformed(store)).withColumnRenamed("id", "doc_id")


@query
def op13_mask_group_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op11_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_documents(read_table(spark, sf_dir, "documents"), k=3, threshold=90)
    return found.withColumnRenamed("id", "doc_id")
