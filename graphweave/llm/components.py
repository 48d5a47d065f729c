"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges by edges to the smallest neighbour, for the larger neighbours of a
node and then for the smaller ones; components shrink to stars in a logarithmic number of
rounds. Every round is written to the shared scratch folder, so a lost executor costs a
task and the plan stays short. Hub nodes are only ever joined with one row of their own
(their smallest neighbour), a join whose hot side Spark splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .written import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges ``(u, v)`` with ``u > v``."""
    if large:  # neighbours of u on both sides; those above u move to the smallest
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    j = near.join(low, "u")
    if large:
        moved = j.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another; the component is
    its smallest node. Null ends, loops and repeated edges are ignored."""
    e = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    state = None
    while True:
        for large in (True, False):
            e = written(_star(e, large), "stars")
        # a round that changes nothing leaves the same edges
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == tuple(now):
            break
        state = tuple(now)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
