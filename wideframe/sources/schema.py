"""Schema handling for uploaded tables: CSV dialects, duplicate headers,
input contract, alignment to a trained column list (S1, S3, P1, P2, P9)."""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.families import ID_COLUMN


def dedupe_names(names, rule: str = "serving") -> list[str]:
    """P1 ``serving``: first kept, later copies ``{name}_v2``, ``_v3``…
    P2 ``index_all``: every copy of a repeated name becomes ``{name}_0``, ``_1``…"""
    names = list(names)
    counts = {}
    for n in names:
        counts[n] = counts.get(n, 0) + 1
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if counts[n] == 1:
            out.append(n)
            continue
        i = seen.get(n, 0)
        seen[n] = i + 1
        if rule == "serving":
            out.append(n if i == 0 else f"{n}_v{i + 1}")
        elif rule == "index_all":
            out.append(f"{n}_{i}")
        else:
            raise ValueError(rule)
    return out


def dedupe_columns(df: DataFrame, rule: str = "serving") -> DataFrame:
    """Rename repeated columns positionally (``toDF``)."""
    return df.toDF(*dedupe_names(df.columns, rule))


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    decimal: str = "."
    encoding: str = "UTF-8"


def sniff_dialect(header: str, valid_utf8: bool = True) -> Dialect:
    """Default comma CSV; a header split by ';' means the ``sep=';'``,
    decimal-comma dialect; a body that is not UTF-8 means latin-1."""
    enc = "UTF-8" if valid_utf8 else "ISO-8859-1"
    if header.count(";") > header.count(","):
        return Dialect(";", ",", enc)
    return Dialect(",", ".", enc)


def _files(spark: SparkSession, paths: list[str]) -> list[dict]:
    """Per file of an upload: its header line and whether every line decodes as
    UTF-8. The check is one scan on the executors; of a file's content only the
    first line reaches the driver."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    # the text source keeps a line's bytes as they are
    checked = lines.groupBy("file").agg(F.expr("bool_and(is_valid_utf8(value))").alias("utf8")).collect()
    out = []
    for r in sorted(checked, key=lambda r: r["file"]):
        raw = bytes(spark.read.text(r["file"]).select(F.col("value").cast("binary").alias("v")).first()["v"]).rstrip(b"\r")
        out.append({"file": r["file"], "utf8": r["utf8"],
                    "header": raw.decode("utf-8" if r["utf8"] else "latin-1").lstrip("\ufeff")})
    return out


def read_csv(spark: SparkSession, path, dialect: Dialect | None = None,
             dedupe_rule: str = "serving") -> tuple[DataFrame, Dialect]:
    """S1 + P1: read uploaded CSV files (a path or a list of paths) as
    all-string columns.

    Every file is read with its own header and dialect and files are united by
    column name, so uploads may order their columns differently. Spark's reader
    would rename repeated headers by appending their index (``F0103`` →
    ``F01031``), corrupting family names, so headers are parsed here,
    de-duplicated, and passed as a positional schema. In the decimal-comma
    dialect a comma between digits of a number becomes a point, in every
    column. The returned dialect is the first file's.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups: dict = {}
    for f in _files(spark, paths):
        d = dialect or sniff_dialect(f["header"], f["utf8"])
        groups.setdefault((f["header"], d), []).append(f["file"])
    if not groups or not all(h.strip() for h, _ in groups):
        empty = [f for (h, _), fs in groups.items() if not h.strip() for f in fs]
        raise ValueError(f"no header line in {', '.join(empty) or ', '.join(paths)}")
    out = None
    for (header, d), files in groups.items():
        names = dedupe_names([h.strip() for h in next(csv.reader(io.StringIO(header), delimiter=d.sep))], dedupe_rule)
        part = (spark.read.option("header", True).option("enforceSchema", True)
                .option("sep", d.sep).option("encoding", d.encoding)
                .schema(StructType([StructField(n, StringType()) for n in names])).csv(files))
        if d.decimal == ",":
            part = part.select(*[F.regexp_replace(F.col(f"`{n}`"), r"^(\s*[-+]?[0-9]*),([0-9]+\s*)$", "$1.$2").alias(n) for n in names])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out, next(iter(groups))[1]


def require_columns(df: DataFrame, required=(ID_COLUMN,)) -> DataFrame:
    """S3: input contract checked on the schema before any job runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required column(s) not found: {', '.join(missing)}")
    return df


SUPPORTED_FORMATS = ("csv", "parquet")


def read_upload(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read a table by format; unknown formats are refused."""
    fmt = (fmt or path.rsplit(".", 1)[-1]).lower()
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"unsupported format '{fmt}': use one of {SUPPORTED_FORMATS}")
    if fmt == "csv":
        return read_csv(spark, path)[0]
    return spark.read.parquet(path)


def align_to(df: DataFrame, trained, keep=(), fill: float = 0.0) -> DataFrame:
    """Reorder to the trained list; absent columns become ``fill``; extras
    are dropped. NULLs in present columns are left as they are."""
    have = set(df.columns)
    cols = [F.col(f"`{k}`") for k in keep]
    for c in trained:
        cols.append(F.col(f"`{c}`").cast("double").alias(c) if c in have else F.lit(fill).cast("double").alias(c))
    return df.select(*cols)


def row_id(df: DataFrame, id_col: str = ID_COLUMN) -> DataFrame:
    """Id column if present, else a generated id (unique, not dense)."""
    if id_col in df.columns:
        return df.withColumn("__row_id", F.col(f"`{id_col}`").cast("string"))
    return df.withColumn("__row_id", F.monotonically_increasing_id().cast("string"))
