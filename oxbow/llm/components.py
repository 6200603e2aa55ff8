"""Connected components of an edge table, with bounded tasks.

Alternating large-star and small-star rounds (Kiveris et al., 2014): each round
is an aggregation by node and a hot-safe join, so a node with a third of all
edges does not pile up in one task. Every round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oxbow.llm.common import join_hot, materialize


def _star(edges: DataFrame, keep) -> DataFrame:
    """Link the kept neighbours of each node to the smallest node around it."""
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    near = materialize(keep(edges.select(F.inline(ways))))
    least = materialize(near.groupBy("u").agg(F.min("v").alias("__m"), F.count(F.lit(1)).alias("__n")))
    return join_hot(near, least, ["u"], "__n").withColumn("__m", F.least("u", "__m"))


def components(edges: DataFrame) -> DataFrame:
    """``u``, ``root`` for every node of ``edges`` (u, v: long): ``root`` is the
    smallest node of its component. Self loops are ignored."""
    edges = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                     F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        large = _star(edges, lambda e: e).where("v > u").select(F.col("v").alias("u"), F.col("__m").alias("v"))
        small = _star(large, lambda e: e.where("v < u"))
        to = [F.struct(F.col(c).alias("u"), F.col("__m").alias("v")) for c in ("v", "u")]
        edges = materialize(small.select(F.inline(F.array(*to))).where("u <> v").distinct())
    roots = edges.select(F.col("v").alias("u")).distinct().withColumn("root", F.col("u"))
    return edges.withColumnRenamed("v", "root").unionByName(roots)
