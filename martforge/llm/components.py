"""Connected components of an edge table, without a graph on the driver.

Alternating star contraction: every round links the larger neighbours of a node
to its smallest neighbour, then the smaller ones.  Rounds are aggregations and
joins on nodes; each round's edges are written to the shared folder, so lineage
stays short.  A node with very many edges is one row on the aggregated side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import write_shared


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b): the smallest node of
    its component.  Loops and repeated edges do not matter."""
    now = write_shared(edges.where("a <> b").select("a", "b").distinct(), "edges")
    while True:
        following = write_shared(_small_star(_large_star(now)), "edges")
        # Stars whose centre is the smallest node do not change any more.
        if following.exceptAll(now).isEmpty() and now.exceptAll(following).isEmpty():
            break
        now = following
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
