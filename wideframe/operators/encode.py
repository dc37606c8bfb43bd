"""One-hot encoding into named 0/1 columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from .profile import col_


def level_name(v) -> str:
    return str(v)


@dataclass
class OneHotModel:
    levels: dict  # column -> sorted list of levels
    as_int: bool = True

    def output_columns(self) -> list[str]:
        return [f"{c}_{level_name(v)}" for c, lv in self.levels.items() for v in lv]

    def transform(self, df: DataFrame) -> DataFrame:
        """Encoded columns replace their source and go to the end, one per
        level; NULL encodes as all zeros."""
        keep = [col_(c) for c in df.columns if c not in self.levels]
        dummies = []
        for c, lv in self.levels.items():
            for v in lv:
                flag = F.coalesce(col_(c) == F.lit(v), F.lit(False))
                dummies.append((flag.cast("int") if self.as_int else flag).alias(f"{c}_{level_name(v)}"))
        return df.select(*keep, *dummies)


class OneHotEncoder:
    """Wide 0/1 columns. The output is one column per level, so the levels must
    fit a schema: pass them, or let ``fit`` find them where their number is
    known to be small. ``indicators`` has no such limit."""

    def __init__(self, cols, levels: dict | None = None, as_int: bool = True):
        self.cols, self.levels, self.as_int = list(cols), levels, as_int

    def fit(self, df: DataFrame) -> OneHotModel:
        if self.levels is not None:
            return OneHotModel({c: list(self.levels[c]) for c in self.cols}, self.as_int)
        types = {f.name: f.dataType for f in df.schema.fields}
        levels = {c: [] for c in self.cols}
        for kind in ("num", "str"):
            cols = [c for c in self.cols if isinstance(types[c], NumericType) == (kind == "num")]
            if not cols:
                continue
            vt = types[cols[0]] if kind == "num" and len({types[c] for c in cols}) == 1 else \
                ("double" if kind == "num" else "string")
            for r in _pairs(df, cols, vt).distinct().collect():
                levels[r["c"]].append(r["v"])
        return OneHotModel({c: sorted(v) for c, v in levels.items()}, self.as_int)


def _pairs(df: DataFrame, cols, vt, *keep) -> DataFrame:
    structs = [F.struct(F.lit(c).alias("c"), col_(c).cast(vt).alias("v")) for c in cols]
    return (df.select(*keep, F.explode(F.array(*structs)).alias("s")).select(*keep, "s.*")
            .filter(F.col("v").isNotNull()))


def indicators(df: DataFrame, id_col: str, cols) -> DataFrame:
    """One-hot in long, sparse form: one row (id, dummy) per present level,
    named as the wide columns are. The size follows the rows, whatever the
    number of levels; no level list is collected."""
    return _pairs(df, cols, "string", col_(id_col)).select(
        id_col, F.concat_ws("_", "c", "v").alias("dummy"))


def bool_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column → 0/1 integer."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]
    return df.withColumns({c: col_(c).cast("int") for c in cols}) if cols else df
