"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word: a run of characters other than space, tab, newline, vertical tab,
#: form feed and carriage return (Java and RE2 syntax).
WORD = r"[^\x20\x09-\x0D]+"

#: Largest table (rows) that ``small_join`` sends to every task. A row is at
#: most a few hundred bytes, so this stays below about 50 MB.
BROADCAST_ROWS = 200_000


#: Rows of a batch that goes to a Python worker.
TEXT_BATCH = 2000


def words_sql(text: str) -> str:
    """SQL for the array of words of ``text`` (null text: empty array)."""
    return rf"array_remove(split(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), '')"


def n_words_sql(text: str) -> str:
    return rf"CAST(regexp_count(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+') AS BIGINT)"


def let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and binds it as lambda variable
    ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def uniform_sql(seed: int, key: str) -> str:
    """A number in (0, 1) from md5 of seed and key: the same on every run and
    in every engine. 52 bits, so the double is exact."""
    return f"(CAST(conv(substr(md5(concat('{int(seed)}:', {key})), 1, 13), 16, 10) AS BIGINT) + 0.5D) / 4503599627370496D"


def ship(spark: SparkSession) -> None:
    """Give the tasks this package, once per Spark context (the usual zip of
    ``--py-files``, for sessions that were started without one). Batches to
    Python are kept small: a row can be a long text."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > TEXT_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH))
    sc = spark.sparkContext
    if getattr(sc, "_wideframe_shipped", False):
        return
    package = pathlib.Path(__file__).resolve().parent.parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="wideframe-code-")) / "wideframe-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._wideframe_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the session."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, rows: int | None = None, per_task: int = 50_000) -> DataFrame:
    """Write to the shared folder and read back: later passes start from the
    table (column pruning, no recomputation after a lost executor). With the
    known number of ``rows`` (a bound will do) the last stage and the table
    get as many parts as ``per_task`` rows need, instead of one for every
    shuffle partition."""
    path = scratch(df.sparkSession, name)
    out = df if rows is None else df.coalesce(max(1, -(-rows // per_task)))
    out.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_join(big: DataFrame, small: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join where ``small`` goes to every task only if its counted rows are
    within ``limit``; otherwise an ordinary (skew-aware) shuffled join."""
    within = small.limit(limit + 1).count() <= limit
    return big.join(F.broadcast(small) if within else small, on, how)


def group_key(col: str) -> str:
    """SQL for a non-null string key of a nullable column (null is a group)."""
    return f"coalesce(concat('v', CAST(`{col}` AS STRING)), 'n')"


def running_total(df: DataFrame, group: list[str], unit: str, order: list[str], value: str, out: str,
                  bins: int) -> DataFrame:
    """Exclusive running sum of ``value`` (long) per group in the order of
    ``unit`` (a double in [0, 1) that ascends with ``order``), without one task
    per group: rows are cut into ``bins`` slices of ``unit``; slice totals give
    each slice its base, and a window within (group, slice) adds the rest."""
    cut = df.withColumn("__bin", F.expr(f"CAST(least(floor({unit} * {bins}), {bins - 1}) AS INT)"))
    keys = [*group, "__bin"]
    totals = cut.groupBy(*keys).agg(F.sum(value).alias("__t"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(*keys, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (cut.join(base, keys)
            .withColumn(out, (F.col("__base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long"))
            .drop("__bin", "__base"))


def bins_for(rows: int) -> int:
    """Slices for ``running_total``: about the square root of the rows, so both
    the slices of a group and the rows of a slice stay small at any size."""
    return max(16, 4 * math.isqrt(rows))


def slices(batch, column: int, chars: int = 2_000_000):
    """The record batch in pieces of about ``chars`` characters of a text
    column (at least one row each), so that Python objects stay few."""
    import numpy as np
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(size, (size[at - 1] if at else 0) + chars, side="right"))
        end = max(end, at + 1)
        yield batch.slice(at, end - at)
        at = end
