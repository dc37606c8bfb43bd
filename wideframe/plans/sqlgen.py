"""DuckDB SQL text for the oracle side of the correctness gate.

The stand-in player table (FIXTURES.md §3) is the shared CTE prefix; helpers
generate the per-column SQL that mirrors the library's generated expressions.
"""

from __future__ import annotations

from ..plans.player import PIVOT_LAYOUT


def qi(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


PLAYER_CTE = """cell AS (
  SELECT l_orderkey k, l_linenumber n, max(l_quantity) q, max(l_extendedprice) p,
         max(l_discount)*100 d, max(l_tax)*100 x
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
agg AS (
  SELECT l_orderkey k, sum(l_quantity) t1, sum(l_extendedprice*(1-l_discount))/1000 t3
  FROM lineitem GROUP BY l_orderkey),
wide AS (
  SELECT k,
    max(CASE WHEN n=1 THEN CASE WHEN q<=5 THEN -1.0 ELSE q END END) AS P01,
    max(CASE WHEN n=2 THEN CASE WHEN q<=5 THEN -1.0 ELSE q END END) AS P02,
    max(CASE WHEN n=3 THEN CASE WHEN q<=5 THEN -1.0 ELSE q END END) AS P03,
    max(CASE WHEN n=4 THEN CASE WHEN q<=5 THEN -1.0 ELSE q END END) AS P04,
    max(CASE WHEN n=5 THEN CASE WHEN q<=5 THEN -1.0 ELSE q END END) AS P09,
    max(CASE WHEN n=6 THEN CASE WHEN q<=5 THEN -1.0 ELSE q END END) AS P12,
    max(CASE WHEN n=7 THEN CASE WHEN q<=5 THEN -1.0 ELSE q END END) AS P13,
    max(CASE WHEN n=1 THEN d END) AS P15,
    max(CASE WHEN n=1 THEN p/1000 END) AS T01,
    max(CASE WHEN n=2 THEN p/1000 END) AS T02,
    max(CASE WHEN n=3 THEN p/1000 END) AS T03,
    max(CASE WHEN n=4 THEN p/1000 END) AS T04,
    max(CASE WHEN n=1 THEN x END) AS F0101,
    max(CASE WHEN n=2 THEN d END) AS F0701, max(CASE WHEN n=3 THEN d END) AS F0702,
    max(CASE WHEN n=1 THEN d END) AS F1101, max(CASE WHEN n=2 THEN x END) AS F1102,
    max(CASE WHEN n=3 THEN x END) AS F1103
  FROM cell GROUP BY k),
player AS (
  SELECT o_orderkey AS player_id, o_orderpriority AS Cor0202, o_orderstatus AS Cor0204,
    replace(CAST(CAST(c_acctbal AS decimal(12,2)) AS varchar(20)), '.', ',') AS F0103,
    CAST(4+o_custkey%6 AS double) AS QtdHorasDormi, CAST(o_orderkey%5 AS double) AS Acordar,
    wide.* EXCLUDE (k), t1 AS Target1, o_totalprice/1000 AS Target2, t3 AS Target3
  FROM orders LEFT JOIN customer ON o_custkey=c_custkey
       LEFT JOIN wide ON o_orderkey=wide.k LEFT JOIN agg ON o_orderkey=agg.k)"""

PLAYER_COLUMNS = (["player_id", "Cor0202", "Cor0204", "F0103", "QtdHorasDormi", "Acordar"]
                  + [name for name, _, _ in PIVOT_LAYOUT] + ["Target1", "Target2", "Target3"])


def with_player(*ctes: str) -> str:
    """``WITH player…, extra CTEs`` prefix."""
    parts = [PLAYER_CTE] + [c for c in ctes if c]
    return "WITH " + ",\n".join(parts) + "\n"


def _list(cols) -> str:
    """The row's values as a list; DuckDB's list aggregates skip NULLs, so the
    row statistics here share no formula with the library's expressions."""
    return "[" + ", ".join(f"CAST({qi(c)} AS DOUBLE)" for c in cols) + "]"


def row_sum(cols) -> str:
    return f"coalesce(list_sum({_list(cols)}), 0.0)" if cols else "0.0"


def row_mean(cols, min_columns: int = 1) -> str:
    return f"list_avg({_list(cols)})" if cols and len(cols) >= min_columns else "0.0"


def row_std(cols) -> str:
    return f"list_stddev_samp({_list(cols)})" if cols else "0.0"


def row_min(cols) -> str:
    return f"list_min({_list(cols)})" if cols else "0.0"


def row_max(cols) -> str:
    return f"list_max({_list(cols)})" if cols else "0.0"


def guarded_corr(x: str, y: str) -> str:
    xs = f"CASE WHEN {y} IS NOT NULL THEN {x} END"
    ys = f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    return (f"(covar_pop({xs}, {ys}) / nullif(stddev_pop({xs}) * stddev_pop({ys}), 0))")


def r6(expr: str) -> str:
    return f"round({expr}, 6)"
