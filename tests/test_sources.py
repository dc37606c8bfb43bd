import datetime as dt

import pytest
from pyspark.sql import functions as F

from wideframe.sources import schema as SC
from wideframe.sources import sinks as SK


def _write(path, text, encoding="utf-8"):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.csv", "wb") as fh:
        fh.write(text.encode(encoding))


def test_csv_duplicate_headers_keep_family_names(spark, tmpdir_path):
    _write(f"{tmpdir_path}/a", "Código de Acesso,F0103,F0103,P01\nx1,\"1,5\",2,3\n")
    df, d = SC.read_csv(spark, f"{tmpdir_path}/a")
    assert d.sep == ","
    assert df.columns == ["Código de Acesso", "F0103", "F0103_v2", "P01"]
    assert df.first()["F0103"] == "1,5"


def test_csv_semicolon_and_latin1(spark, tmpdir_path):
    _write(f"{tmpdir_path}/b", "Código de Acesso;P01;F0103\nj1;3;2,5\n", encoding="latin-1")
    df, d = SC.read_csv(spark, f"{tmpdir_path}/b")
    assert (d.sep, d.decimal, d.encoding) == (";", ",", "ISO-8859-1")
    assert df.columns == ["Código de Acesso", "P01", "F0103"]
    assert df.first()["F0103"] == "2.5"      # the dialect's decimal comma is applied


def test_csv_files_keep_their_own_header_and_dialect(spark, tmpdir_path):
    base = f"{tmpdir_path}/up"
    _write(f"{base}/a", "id,P01,T01\n1,10,20\n")
    _write(f"{base}/b", "id,T01,P01\n2,21,11\n")
    _write(f"{base}/c", "id;P01;T01\n3;2,5;-0,25\n")
    _write(f"{base}/d", "id,P01,cor\n4,1,vermelh\u00e3o\n", encoding="latin-1")
    df, _ = SC.read_csv(spark, f"{base}/*")
    got = {r["id"]: (r["P01"], r["T01"], r["cor"]) for r in df.collect()}
    assert got == {"1": ("10", "20", None), "2": ("11", "21", None), "3": ("2.5", "-0.25", None), "4": ("1", None, "vermelh\u00e3o")}
    _write(f"{tmpdir_path}/e", "\n1,2\n")
    with pytest.raises(ValueError, match="no header"):
        SC.read_csv(spark, f"{tmpdir_path}/e")


def test_input_contract(spark, tmpdir_path):
    df = spark.createDataFrame([(1,)], "P01 int")
    with pytest.raises(ValueError, match="Código de Acesso"):
        SC.require_columns(df)
    with pytest.raises(ValueError, match="unsupported"):
        SC.read_upload(spark, f"{tmpdir_path}/x.txt")


def test_align_to_trained_list(spark):
    df = spark.createDataFrame([(1, 2.0, None, 9.0)], "id int, b double, a double, extra double")
    out = SC.align_to(df, ["a", "b", "missing"], keep=["id"])
    assert out.columns == ["id", "a", "b", "missing"]
    r = out.first()
    assert r["a"] is None and r["b"] == 2.0 and r["missing"] == 0.0   # fill only for absent columns


def test_history_append_and_counts(spark, tmpdir_path):
    path = f"{tmpdir_path}/hist"
    preds = spark.createDataFrame([("a", 1.0, 2.0, 3.0), ("b", 1.5, 2.5, 3.5)],
                                  "`Código de Acesso` string, `Previsão T1` double, `Previsão T2` double, `Previsão T3` double")
    SK.append_history(preds, path, 1, "r", 0, dt.datetime(2024, 1, 1, 10, 0, 0))
    SK.append_history(preds, path, 1, "r", 0, dt.datetime(2024, 1, 1, 10, 0, 0))    # written again: no copy
    SK.append_history(preds.limit(1), path, 1, "r", 1, dt.datetime(2024, 1, 2, 10, 0, 0))
    SK.append_history(preds, path, 2, "other", 0, dt.datetime(2024, 1, 3, 10, 0, 0))
    hist = SK.read_history(spark, path)
    assert hist.count() == 5
    got = [tuple(r) for r in SK.history_counts(hist, 1).collect()]
    assert got == [("2024-01-02 10:00:00", 1), ("2024-01-01 10:00:00", 2)]   # newest first


def test_metrics_table_missing_target(spark, tmpdir_path):
    path = f"{tmpdir_path}/metrics"
    SK.save_metrics(spark, {"target1": {"r2_train": 0.73, "r2_test": 0.65}}, path)
    rows = {r["target"]: r for r in SK.load_metrics(spark, path).collect()}
    assert rows["target1"]["r2_test"] == 0.65 and rows["target3"]["r2_test"] is None
    absent = SK.load_metrics(spark, f"{tmpdir_path}/absent")
    assert absent.count() == 3 and set(absent.columns) == {"target", *SK.METRIC_FIELDS}
    open(f"{tmpdir_path}/broken", "w").write("no table")
    with pytest.raises(Exception):
        SK.load_metrics(spark, f"{tmpdir_path}/broken").collect()


def test_export_tables(spark, tmpdir_path):
    df = spark.range(3)
    paths = SK.export_tables({"clean": df, "scaled": df}, f"{tmpdir_path}/out", fmt="csv")
    assert spark.read.option("header", True).csv(paths[0]).count() == 3


def test_row_id_fallback(spark):
    with_id = spark.createDataFrame([(7, 1.0)], "`Código de Acesso` int, x double")
    assert SC.row_id(with_id).first()["__row_id"] == "7"
    no_id = spark.range(5).withColumnRenamed("id", "x")
    ids = [r["__row_id"] for r in SC.row_id(no_id).collect()]
    assert len(set(ids)) == 5
