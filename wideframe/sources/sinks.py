"""Sinks: exports, append-only prediction history, metrics table."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import format_ts
from .tables import read_table

HISTORY_COLUMNS = ("id", "user_id", "upload_timestamp", "jogador_id", "pred_t1", "pred_t2", "pred_t3")


def history_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction history laid out like the fact table, derived from ``events``:
    one upload batch per user and day, one stored prediction per event."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("id"), F.col("user_id"),
        F.date_trunc("day", "ts").alias("upload_timestamp"),
        F.col("event_id").cast("string").alias("jogador_id"),
        F.col("value").alias("pred_t1"), (F.col("value") * 2).alias("pred_t2"),
        (F.col("value") / 2).alias("pred_t3"))


def history_counts(hist: DataFrame, user_id: int) -> DataFrame:
    """A15 + F4 + L10: players per upload for one user, newest first.
    The user filter is a plain predicate, pushed into the parquet scan."""
    return (hist.filter(F.col("user_id") == user_id)
            .groupBy("upload_timestamp").agg(F.count("id").alias("num_jogadores"))
            .orderBy(F.desc("upload_timestamp"))
            .select(format_ts("upload_timestamp").alias("timestamp"), "num_jogadores"))


def append_history(preds: DataFrame, path: str, user_id: int, run_id: str, batch_id: int = 0,
                   batch_ts: dt.datetime | None = None, id_col: str = "Código de Acesso") -> None:
    """Append one batch of predictions with a single upload timestamp, from
    batch jobs and streams alike. A batch lives in its own (run, batch) folder
    and is written with overwrite, so writing it again after a failure changes
    nothing; another run never touches it."""
    batch_ts = batch_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    preds.select(
        F.xxhash64(F.col(f"`{id_col}`").cast("string"), F.lit(run_id), F.lit(batch_id)).alias("id"),
        F.lit(user_id).cast("int").alias("user_id"),
        F.lit(batch_ts).cast("timestamp").alias("upload_timestamp"),
        F.col(f"`{id_col}`").cast("string").alias("jogador_id"),
        F.col("`Previsão T1`").cast("double").alias("pred_t1"),
        F.col("`Previsão T2`").cast("double").alias("pred_t2"),
        F.col("`Previsão T3`").cast("double").alias("pred_t3"),
    ).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run_id={run_id}/batch_id={int(batch_id)}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """the stored history; filters on user or player reach the scan."""
    return spark.read.parquet(path).select(*HISTORY_COLUMNS, "run_id", "batch_id")


def export_tables(tables: dict, base: str, fmt: str = "parquet") -> list[str]:
    """Write several named outputs (clean, scaled, summaries…)."""
    paths = []
    for name, df in tables.items():
        p = f"{base.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", True).csv(p)
        else:
            w.parquet(p)
        paths.append(p)
    return paths


METRIC_FIELDS = ("r2_train", "r2_test", "r2_loo_cv", "mae_test", "mae_loo", "rmse_test", "rmse_loo",
                 "overfitting_pct", "n_features", "ensemble_size")


def save_metrics(spark: SparkSession, records: dict, path: str) -> None:
    """One metrics row per target."""
    rows = [(t, *[None if m.get(f) is None else float(m.get(f)) for f in METRIC_FIELDS])
            for t, m in records.items()]
    schema = "target string, " + ", ".join(f"{f} double" for f in METRIC_FIELDS)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def load_metrics(spark: SparkSession, path: str, targets=("target1", "target2", "target3")) -> DataFrame:
    """Metrics per requested target; a target without a row, or a table
    that does not exist yet, gives NULLs. Any other read error is raised."""
    keys = spark.createDataFrame([(t,) for t in targets], "target string")
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return keys.withColumns({f: F.lit(None).cast("double") for f in METRIC_FIELDS})
    return keys.join(stored, "target", "left")
