"""Connected components of a graph given as edges, without a driver that sees them.

Alternates large-star and small-star steps: each replaces the neighbours' links by links to the
smallest neighbour, until every node hangs on the smallest node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelyard.llm.common import drop, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: a > b. The result has the same form."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        linked = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        near = edges.join(least, "a")
        linked = near.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return linked.where("a > b").distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), long, any direction, repeats and loops allowed: node, root for linked nodes.

    root is the smallest node of the component; nodes without a link don't appear. Each round's
    edges are a table in the shared folder, so a lost executor costs at most a round.
    """
    now = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges"
    )
    mark = _print(now)
    while mark[0]:
        new = stage(_star(_star(now, True), False), "edges")
        drop(now.sparkSession, now)
        before, mark, now = mark, _print(new), new
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
