"""Connected components of an undirected link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` with the least node among ``u`` and its neighbours."""
    return edges.join(edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "u")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; ``root`` is the smallest node reachable.

    Large-star and small-star steps in turn: every node hands its larger neighbours, then its smaller
    ones and itself, to the least node it knows. Components become stars after a number of rounds that
    grows with the logarithm of their size. Only two columns of node numbers are shuffled, minima are
    taken before the shuffle, and every round's table is written to the shared folder, so losing an
    executor costs one round.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_least(large)
        edges = materialize(small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(
            F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct())
        # done when every node either hangs on one other or is hung on
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(
            F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")).select("e.*")
        degree = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if degree.where("up > 1 or (up = 1 and down = 1)").isEmpty():
            break
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(centres))
