"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).collect()[0]
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("_m").alias("v")).where(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("_m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.union(least.select("u", F.col("_m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the least node reachable.

    Only minima are gathered per node, so a hub of any degree is no group in one task. The edges
    after every round are written; the number of rounds grows with the logarithm of the graph."""
    now = written(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where(F.col(u) != F.col(v))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(now)
    if not before[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
