"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrade.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long), component its smallest node.

    Each round hooks every node to its smallest neighbour if that is smaller, follows the
    pointers to their ends by repeated doubling, and replaces the nodes of the remaining edges
    by these ends. Both counts fall geometrically, so the number of rounds is logarithmic.
    Every table is stored before it is joined: joins then read plain shuffles, which adaptive
    execution splits when one node has a large share of the edges. Only counts reach the driver.
    """
    edges = stored(edges.where("a <> b").selectExpr("least(a, b) AS a", "greatest(a, b) AS b").distinct(), "edges")
    labels = None
    while True:
        both = edges.unionAll(edges.selectExpr("b AS a", "a AS b"))
        pointers = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "hooks")
        while True:
            far = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = stored(
                pointers.join(far, "root", "left").select(
                    "node", F.coalesce("next", "root").alias("root"), (F.col("next") < F.col("root")).alias("moved")
                ),
                "jumps",
            )
            pointers = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = pointers.withColumnRenamed("root", "component")
        else:
            step = pointers.select(F.col("node").alias("component"), F.col("root").alias("next"))
            labels = stored(
                labels.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component")),
                "labels",
            )
        left = pointers.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = pointers.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stored(
            edges.join(left, "a").join(right, "b").where("ra <> rb").selectExpr("least(ra, rb) AS a", "greatest(ra, rb) AS b").distinct(),
            "edges",
        )
        if edges.isEmpty():
            return labels
