"""Score files as they arrive and append them to the prediction history.

``readStream`` lists the uploaded CSV files (their content is not part of the
stream) → each micro-batch reads its files with their own header, dialect and
encoding → the frozen scoring plan (projection only, no per-batch statistics) →
the history writer, keyed by run and batch. A replayed batch after a failure
overwrites its own folder, so the history stays exactly-once; another stream
over the same history has another run id. Progress lives in a checkpoint folder
on shared storage.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..plans.scoring import ScoringPlan, score
from ..sources.schema import read_csv, require_columns
from ..sources.sinks import append_history


def start_scoring_stream(spark: SparkSession, in_dir: str, history_path: str, checkpoint: str, plan: ScoringPlan,
                         id_col: str, user_id: int = 1, available_now: bool = True, run_id: str | None = None,
                         files_per_batch: int = 16):
    run_id = run_id or hashlib.md5(checkpoint.encode()).hexdigest()[:16]
    stream = (spark.readStream.format("binaryFile").option("maxFilesPerTrigger", files_per_batch)
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", "*.csv").load(in_dir).select("path"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.collect()]  # at most files_per_batch names
        if files:
            upload, _ = read_csv(spark, files)
            append_history(score(require_columns(upload, (id_col,)), plan, id_col), history_path, user_id, run_id, batch_id)

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_until_done(query, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` stream. With a limit, a stream that is
    still running then is stopped and reported: its history is incomplete."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout_s} s: the history is incomplete")
    if query.exception() is not None:
        raise query.exception()
