"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
FILE_SPLIT = "spark.sql.files.maxPartitionBytes"

# Settings the library assumes. AQE re-plans joins and shuffle sizes at
# runtime (broadcast only after it has measured a side), and splits skewed
# shuffle partitions. UTC keeps timestamps identical to the DuckDB oracle. The
# JVM interprets methods of over 8000 bytes, which the projections of a wide
# table exceed when a stage becomes one method; above that limit Spark compiles
# them in parts. A task that reads a file piece groups its rows in memory before
# the shuffle, so pieces are small ones at every size of the file.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    METHOD_LIMIT: "8000",
    FILE_SPLIT: "16m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "wideframe",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, rows: int, rows_per_task: int) -> None:
    """Let shuffles start with a partition per ``rows_per_task`` rows, or with
    the session's own number if that is larger; AQE joins small ones again."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(FIRST_PARTITIONS, str(max(own, -(-rows // rows_per_task))))


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle of this session starts with."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(FIRST_PARTITIONS, "1")))


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` must point to shared storage and is
    only read here. A private folder is created only for a local master
    (tests), where no setting exists.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
    path = tempfile.mkdtemp(prefix="wideframe-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never a local one."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A table path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)
