import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wideframe.functions import clean as C
from wideframe.functions import families as FAM
from wideframe.functions.rowstats import with_row_stats
from wideframe.sources.schema import dedupe_names


def test_family_rules():
    cols = ["Código de Acesso", "P01", "P02_1", "PTempoTotalExpl", "T01", "TempoTotalExpl", "Target1",
            "F", "F0103", "F0107", "F0701", "F1103", "QtdHorasDormi"]
    assert FAM.family(cols, "P") == ["P01", "P02_1"]
    assert FAM.family(cols, "T") == ["T01"]                       # targets excluded by default
    assert FAM.family(cols, "T", exclude=()) == ["T01", "Target1"]  # literal rule (Q2)
    assert FAM.family(cols, "F") == ["F0103", "F0107", "F0701", "F1103"]
    f = FAM.family(cols, "F")
    assert FAM.by_prefix(f, "F07") == ["F0701"]
    assert FAM.by_substring(f, "07") == ["F0107", "F0701"]        # P5 differs from P4
    assert FAM.group_columns(["P09", "P12", "P13"], FAM.LATE_GROUP, "exact") == ["P09", "P12", "P13"]
    assert not FAM.all_present(["P09", "P12", "P13"], FAM.LATE_GROUP)
    assert FAM.group_columns(["P01", "P01_1", "P02"], ("P01",), "prefix") == ["P01", "P01_1"]
    assert FAM.one_hot_columns(["Cor0202_A", "XCor0202", "P01_3.0"], rule="prefix") == ["Cor0202_A", "P01_3.0"]
    assert FAM.one_hot_columns(["Cor0202_A", "XCor0202"], rule="contains") == ["Cor0202_A", "XCor0202"]
    assert FAM.ordered_unique(["a", "b", "a", "c"]) == ["a", "b", "c"]


def test_dedupe_names():
    names = ["id", "F0103", "P01", "F0103", "P01", "P01"]
    assert dedupe_names(names, "serving") == ["id", "F0103", "P01", "F0103_v2", "P01_v2", "P01_v3"]
    assert dedupe_names(names, "index_all") == ["id", "F0103_0", "P01_0", "F0103_1", "P01_1", "P01_2"]


def test_scalar_cleaning(spark):
    df = spark.createDataFrame([("1,5", -1.0, -5.0, 10001.0, 0.125), ("abc", 3.0, 0.0, -100.0, 0.135),
                                (None, None, None, None, None)], "s string, a double, b double, c double, r double")
    out = df.select(C.decimal_comma("s").alias("s"), C.null_sentinel("a").alias("a"),
                    C.null_negative("b").alias("b"), C.range_guard("c").alias("c"),
                    C.round_half_even("r", 2).alias("r"), C.nan_safe("a").alias("z")).collect()
    assert out[0]["s"] == 1.5 and out[1]["s"] is None and out[2]["s"] is None
    assert out[0]["a"] is None and out[1]["a"] == 3.0
    assert out[0]["b"] is None and out[1]["b"] == 0.0
    assert out[0]["c"] is None and out[1]["c"] == -100.0          # bounds are inclusive
    assert out[0]["r"] == 0.12                                     # half-even
    assert out[2]["z"] == 0.0
    with pytest.raises(Exception):
        df.select(C.decimal_comma("s", strict=True)).collect()     # strict: bad text fails


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([("nan",), ("2",)], "s string")
    vals = [r[0] for r in df.select(C.to_number("s")).collect()]
    assert vals[0] is None and vals[1] == 2.0


def test_format_ts(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp")
    assert df.select(C.format_ts("ts")).first()[0] == "2024-01-02 03:04:05"


cells = st.one_of(st.none(), st.floats(min_value=-1e4, max_value=1e4, allow_nan=False).map(lambda x: round(x, 3)))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(cells, cells, cells, cells), min_size=1, max_size=8))
def test_row_stats_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    cols = ["a", "b", "c", "d"]
    out = with_row_stats(df, {"m": ("mean", cols), "s": ("std", cols), "lo": ("min", cols),
                              "hi": ("max", cols), "t": ("sum", cols)}).collect()
    for r, src in zip(out, rows):
        vals = np.array([v for v in src if v is not None], dtype=float)
        if len(vals) == 0:
            assert r["m"] is None and r["lo"] is None and r["t"] == 0.0
            continue
        assert math.isclose(r["m"], vals.mean(), rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["t"], vals.sum(), rel_tol=1e-9, abs_tol=1e-9)
        assert r["lo"] == vals.min() and r["hi"] == vals.max()
        if len(vals) < 2:
            assert r["s"] is None
        else:
            assert math.isclose(r["s"], vals.std(ddof=1), rel_tol=1e-7, abs_tol=1e-7)


def test_empty_column_list_gives_zero(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    r = with_row_stats(df, {"m": ("mean", []), "s": ("std", [])}).first()
    assert r["m"] == 0.0 and r["s"] == 0.0


def test_sql_literals_keep_python_types(spark):
    import datetime
    from decimal import Decimal

    from wideframe.functions.sqltext import lit, q
    vals = [1.5, -2.25, 1e-05, 1e16, -3, 0, 3_000_000_000, "it's", "a\\b", Decimal("1.20"),
            datetime.date(2024, 1, 2), True, None, np.float64(0.1), np.int64(7)]
    row = spark.sql("SELECT " + ", ".join(f"{lit(v)} AS {q(f'c{i}')}" for i, v in enumerate(vals))).first()
    want = [v.item() if isinstance(v, np.generic) else v for v in vals]
    assert list(row) == want
    assert math.isnan(spark.sql(f"SELECT {lit(float('nan'))}").first()[0])
    # quoted names with odd characters resolve
    df = spark.createDataFrame([(1.0,)], "`a-b c` double")
    assert df.selectExpr(f"{q('a-b c')} * 2 AS x").first()["x"] == 2.0


def test_rules_compose_as_sql(spark):
    df = spark.createDataFrame([("-1",), ("2,5",), ("nan",), ("x",)], "s string")
    out = df.select(C.null_sentinel(C.decimal_comma("s", as_sql=True)).alias("v")).collect()
    assert [r["v"] for r in out] == [None, 2.5, None, None]
