"""Connected components of a link table, by minimum labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node
    that can be reached. Every round takes the smallest label of the
    neighbours and then the label of that label, so labels travel in doubling
    steps; a round starts from a stored table. Minima are combined before the
    shuffle; nothing is gathered per node. ``rows`` bounds the links."""
    n = rows if rows is not None else edges.count()
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other").distinct(), "edges", 2 * n)
    label = stored(both.groupBy("node").agg(F.least(F.min("other"), F.min("node")).alias("component")), "labels", 2 * n)
    while True:
        near = (both.join(label.select(F.col("node").alias("other"), F.col("component").alias("c")), "other")
                .groupBy("node").agg(F.min("c").alias("c")))
        down = (label.withColumnRenamed("component", "old").join(near, "node")
                .select("node", "old", F.least("old", "c").alias("low")))
        # nodes that others point to pass their own label on
        jump = (down.join(label.select(F.col("node").alias("low"), F.col("component").alias("next")), "low", "left")
                .select("node", "old", F.least("low", F.coalesce("next", "low")).alias("component")))
        jump = stored(jump, "labels", 2 * n)
        if not jump.filter("component < old").limit(1).count():
            return jump.select("node", "component")
        label = jump.select("node", "component")
