import os

import duckdb
import pytest

import __spark_entry__ as E
from wideframe.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Cor0202", "avg_p_mean", "players"]


def test_contract_keys():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 58


@pytest.mark.parametrize("name", ["perf_by_priority", "missing_profile", "features_target1", "corr_report",
                                  "one_hot", "cluster_report", "metrics_by_split", "interactions_target1",
                                  "corr_rank_target1", "describe", "skip_rates", "quantile_uniform",
                                  "export_readback"])
def test_oracle_agrees_on_small_tables(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sdf = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)

    def canon(rows, cols):
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        out = []
        for r in rows:
            out.append(tuple(None if r[i] is None else (round(float(r[i]), 6) if isinstance(r[i], float) else r[i])
                             for i in order))
        return sorted(out, key=repr)

    assert canon([tuple(r) for r in sdf.collect()], sdf.columns) == canon(res.fetchall(), dcols)
