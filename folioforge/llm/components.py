"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import materialize


def _toward_least(edges: DataFrame) -> DataFrame:
    """Large star: every node's larger neighbours move to the least node of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _smaller_star(edges: DataFrame) -> DataFrame:
    """Small star: every node and its smaller neighbours move to the least of these neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an edge; root is the least node that it reaches.

    Each round is written to the shared folder, and the rounds end when the edges no longer change; their number grows
    with the logarithm of the number of nodes. Neighbourhoods are only ever reduced to their least node, which partial
    aggregation does before the shuffle, so a node with very many edges is no hot spot. An empty edge table gives no rows.
    Loops, repeated edges and either direction are allowed; edges with a null end are left out.
    """
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(F.col(u).isNotNull() & F.col(v).isNotNull()).where("u > v").distinct()
    now = materialize(now, "edges")
    mark = _mark(now)
    while mark[0]:
        now = materialize(_smaller_star(_toward_least(now)), "edges")
        if (new := _mark(now)) == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    """Stands for the set of edges: their number, and sums of two hashes taken modulo a prime so that they don't overflow."""
    h = [F.sum(F.pmod(F.xxhash64("u", "v", F.lit(i)), F.lit(2147483647))).alias(f"h{i}") for i in range(2)]
    return tuple(edges.agg(F.count("*").alias("n"), *h).first())
