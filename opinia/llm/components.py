"""Connected components of an undirected graph by alternating stars.

Each round is two equi-joins and three aggregations; the number of rounds grows with the
logarithm of the number of nodes. The driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.llm.common import Scratch


def _point_to_least(links: DataFrame, mins: DataFrame) -> DataFrame:
    """(u, v) with the least neighbour ``m`` of u: v is linked to m, unless it is m."""
    return links.join(mins, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    mins = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _point_to_least(both.where("v > u"), mins).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Every edge has u > v here.
    mins = edges.groupBy("u").agg(F.min("v").alias("m"))
    own = mins.select("u", F.col("m").alias("v"))
    return _point_to_least(edges, mins).unionByName(own).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges(u, v)`` to ``(u, v)``: one row per linked node that is not the least of its
    component, with that least node. Loops and repeated edges are allowed, nulls are not.
    """
    now = scratch.store(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    mark = F.expr("struct(count(*) AS n, bit_xor(xxhash64(u, v)) AS x)")
    seen = now.agg(mark.alias("s")).first()["s"]
    if seen["n"] == 0:
        return now
    while True:
        after = scratch.store(_small_star(_large_star(now)), "star")
        reached = after.agg(mark.alias("s")).first()["s"]
        scratch.drop(now)
        now = after
        if reached == seen:
            return now
        seen = reached
