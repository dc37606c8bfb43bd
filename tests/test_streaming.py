import os

import pytest
from pyspark.sql import functions as F

from wideframe.plans.catalog import FIXED_ENSEMBLE_SCALE, FIXED_LINEAR
from wideframe.plans.player import player_table
from wideframe.plans.scoring import fit_scoring_plan, score
from wideframe.streaming.score_stream import run_until_done, start_scoring_stream

SF = "/root/testdata/sf0.001"


def test_stream_scores_every_upload_once(spark, tmpdir_path):
    raw = player_table(spark, SF).withColumnRenamed("player_id", "Código de Acesso")
    plan = fit_scoring_plan(raw, linear=FIXED_LINEAR, ensemble_scale=FIXED_ENSEMBLE_SCALE)
    text = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
    inbox = f"{tmpdir_path}/inbox"
    for k in range(2):
        text.filter(F.col("`Código de Acesso`").cast("long") % 2 == k).write.option("header", True).csv(f"{inbox}/u{k}")
    hist, ck = f"{tmpdir_path}/hist", f"{tmpdir_path}/ck"
    run_until_done(start_scoring_stream(spark, f"{inbox}/*", hist, ck, plan, "Código de Acesso"))
    first = spark.read.parquet(hist)
    n = raw.count()
    assert first.count() == n and first.select("jogador_id").distinct().count() == n
    # a restart over the same checkpoint finds nothing new: no duplicates
    run_until_done(start_scoring_stream(spark, f"{inbox}/*", hist, ck, plan, "Código de Acesso"))
    assert spark.read.parquet(hist).count() == n
    # streaming result equals batch scoring with the same frozen plan
    batch = {r[0]: tuple(r[1:]) for r in score(text, plan, "Código de Acesso").collect()}
    streamed = {r["jogador_id"]: (r["pred_t1"], r["pred_t2"], r["pred_t3"]) for r in first.collect()}
    assert batch == streamed
    # another stream over the same uploads adds its own batches and leaves the first's
    run_until_done(start_scoring_stream(spark, f"{inbox}/*", hist, f"{ck}2", plan, "Código de Acesso"))
    assert spark.read.parquet(hist).count() == 2 * n


def test_a_stream_that_hits_its_limit_is_an_error():
    class Slow:
        stopped = False

        def awaitTermination(self, timeout=None):
            return False

        def stop(self):
            self.stopped = True

    q = Slow()
    with pytest.raises(TimeoutError, match="incomplete"):
        run_until_done(q, timeout_s=1)
    assert q.stopped
