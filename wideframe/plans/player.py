"""Stand-in player table (one row per order) built from the driver tables.

The wide player table of the original project is not public, so a table with
the same column families is derived from ``orders``/``lineitem``/``customer``
(see FIXTURES.md). Plan shape, chosen for scale:

* every lineitem-derived column is a conditional aggregate over raw lineitem
  grouped by the order key. Max of a monotone transform equals the transform of
  the max, so the per-(order, line) pre-aggregation of the fixture SQL folds
  into the same single ``groupBy``: one shuffle, of the columns it needs. Lines
  are dealt by order key before they are grouped (an order has about four), so a
  task that reads a file piece holds no table of orders, and one that groups has
  a bounded number of lines;
* ``orders`` is joined to ``customer`` while it is still narrow, then to the
  lineitem aggregate, which is already hash-partitioned on the order key, so
  only the narrow orders side moves for that join. Join strategy is left to
  AQE: it broadcasts a side only after measuring it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shuffle_partitions, size_shuffles
from ..sources.tables import read_table

ID_COL = "player_id"
TARGETS = ("Target1", "Target2", "Target3")

# Fixed layout of the stand-in table (FIXTURES.md §3): output column, line
# number it is taken from, and which lineitem measure feeds it.
# measure: q = quantity with q<=5 recorded as the skip answer -1,
#          d = discount*100, x = tax*100, p = extendedprice/1000
PIVOT_LAYOUT = [
    ("P01", 1, "q"), ("P02", 2, "q"), ("P03", 3, "q"), ("P04", 4, "q"),
    ("P09", 5, "q"), ("P12", 6, "q"), ("P13", 7, "q"), ("P15", 1, "d"),
    ("T01", 1, "p"), ("T02", 2, "p"), ("T03", 3, "p"), ("T04", 4, "p"),
    ("F0101", 1, "x"), ("F0701", 2, "d"), ("F0702", 3, "d"),
    ("F1101", 1, "d"), ("F1102", 2, "x"), ("F1103", 3, "x"),
]


#: Lineitem rows (of about four per order) that one task aggregates.
ROWS_PER_TASK = 500_000

# SQL text of each measure (one parse per aggregate instead of a JVM call per
# operand; see functions/sqltext.py)
_MEASURE = {
    "q": "CASE WHEN l_quantity <= 5 THEN -1D ELSE l_quantity END",
    "d": "l_discount * 100",
    "x": "l_tax * 100",
    "p": "l_extendedprice / 1000",
}


def lineitem_wide(lineitem: DataFrame) -> DataFrame:
    aggs = [F.expr(f"max(CASE WHEN l_linenumber = {line} THEN {_MEASURE[kind]} END)").alias(name)
            for name, line, kind in PIVOT_LAYOUT]
    aggs += [F.expr("sum(l_quantity)").alias("Target1"),
             F.expr("sum(l_extendedprice * (1 - l_discount)) / 1000").alias("Target3")]
    dealt = lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    dealt = dealt.repartition(shuffle_partitions(lineitem.sparkSession), "l_orderkey")
    return dealt.groupBy(F.col("l_orderkey").alias("k")).agg(*aggs)


# column names of the player table, known without building its plan
PLAYER_COLUMNS = ([ID_COL, "Cor0202", "Cor0204", "F0103", "QtdHorasDormi", "Acordar"]
                  + [name for name, _, _ in PIVOT_LAYOUT] + list(TARGETS))


def player_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    lineitem = read_table(spark, sf_dir, "lineitem")
    size_shuffles(spark, lineitem.count(), ROWS_PER_TASK)
    wide = lineitem_wide(lineitem)

    oc = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
    joined = oc.join(wide, oc.o_orderkey == wide.k, "left")
    return joined.selectExpr(
        f"o_orderkey AS {ID_COL}",
        "o_orderpriority AS Cor0202",
        "o_orderstatus AS Cor0204",
        "regexp_replace(CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING), '\\\\.', ',') AS F0103",
        "CAST(4 + o_custkey % 6 AS DOUBLE) AS QtdHorasDormi",
        "CAST(o_orderkey % 5 AS DOUBLE) AS Acordar",
        *[name for name, _, _ in PIVOT_LAYOUT],
        "Target1",
        "o_totalprice / 1000 AS Target2",
        "Target3",
    )
