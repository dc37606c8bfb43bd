"""Column-family and column-list selection (driver-side lists over a schema).

All functions take column names (``df.columns``) and return ordered lists;
expressions are generated from them elsewhere. Nothing here touches data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, NumericType

# The three families are named by their first letter; the F
# family also needs more than one character. Sub-families and the late/early
# answer groups are named lists.
FAMILY_PREFIXES = ("P", "T", "F")
F_PROFILE_PREFIXES = ("F01", "F02")
F_SLEEP_PREFIX = "F07"
F_FINAL_PREFIX = "F11"
LATE_GROUP = ("P09", "P12", "P13", "P15")
EARLY_GROUP = ("P01", "P02", "P03", "P04")
SLEEP_COLUMNS = ("QtdHorasSono", "QtdHorasDormi", "Acordar")
CATEGORICAL_COLUMNS = (
    "Cor0202", "Cor0204", "Cor0206", "Cor0208", "Cor0209Outro",
    "P01", "P02", "P03", "P04", "P05", "P07", "P08", "P09", "P10",
    "P12", "P13", "P15", "P12_1", "P02_1", "P03_1", "P09_1",
)
TARGET_COLUMNS = ("Target1", "Target2", "Target3")
IGNORED_COLUMNS = (
    "Código de Acesso", "Data/Hora Último",
    "L0210 (não likert)",
    "F0299 - Explicação Tempo", "T0499 - Explicação Tempo",
    "PTempoTotalExpl", "T1199Expl", "T1205Expl", "T1210Expl",
    "TempoTotalExpl",
)
ID_COLUMN = "Código de Acesso"
TIME_COLUMN = "Data/Hora Último"


def _has_digit(name: str) -> bool:
    return any(ch.isdigit() for ch in name)


def family(columns, prefix: str, exclude=TARGET_COLUMNS) -> list[str]:
    """Columns starting with ``prefix`` and holding a digit (F: length > 1).

    Targets (``Target1``… also match the T rule) are excluded by default (Q2);
    pass ``exclude=()`` for the literal behaviour.
    """
    min_len = 2 if prefix == "F" else 1
    ex = set(exclude)
    return [c for c in columns
            if c.startswith(prefix) and len(c) >= min_len and _has_digit(c) and c not in ex]


def families(columns, exclude=TARGET_COLUMNS) -> dict[str, list[str]]:
    return {p: family(columns, p, exclude) for p in FAMILY_PREFIXES}


def all_family_columns(columns, exclude=TARGET_COLUMNS) -> list[str]:
    """Union of P, T, F in schema order (the serving rule)."""
    fam = set().union(*families(columns, exclude).values())
    return [c for c in columns if c in fam]


def by_prefix(columns, prefixes) -> list[str]:
    """Sub-family by prefix (``F07`` → ``F0701``...)."""
    prefixes = (prefixes,) if isinstance(prefixes, str) else tuple(prefixes)
    return [c for c in columns if c.startswith(prefixes)]


def by_substring(columns, token: str) -> list[str]:
    """P5: sub-family by substring (``'07' in c``), the target-3 rule."""
    return [c for c in columns if token in c]


def group_columns(columns, names, match: str = "exact") -> list[str]:
    """late/early groups. ``exact`` keeps listed names that exist;
    ``prefix`` keeps every column starting with one of them, in name order."""
    if match == "exact":
        return [n for n in names if n in columns]
    if match == "prefix":
        return [c for n in names for c in columns if c.startswith(n)]
    raise ValueError(match)


def all_present(columns, names) -> bool:
    return all(n in columns for n in names)


def numeric_columns(df: DataFrame, exclude=(), include_bool: bool = False) -> list[str]:
    """Numeric (optionally boolean) columns minus an exclusion list."""
    ex = set(exclude)
    out = []
    for f in df.schema.fields:
        ok = isinstance(f.dataType, NumericType) or (include_bool and isinstance(f.dataType, BooleanType))
        if ok and f.name not in ex:
            out.append(f.name)
    return out


def bool_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]


def one_hot_columns(features, categoricals=CATEGORICAL_COLUMNS, rule: str = "prefix") -> list[str]:
    """Which features came from one-hot encoding.

    ``prefix`` (default) matches ``{cat}_`` exactly as the encoder names its
    output; ``contains`` is the literal substring rule, which also catches
    unrelated names holding a categorical's name.
    """
    if rule == "prefix":
        return [f for f in features if any(f.startswith(c + "_") for c in categoricals)]
    if rule == "contains":
        return [f for f in features if any(c in f for c in categoricals)]
    raise ValueError(rule)


def ordered_unique(names) -> list[str]:
    """K6: ordered de-duplication."""
    return list(dict.fromkeys(names))
