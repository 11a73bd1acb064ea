"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.store import stored


def components(edges: DataFrame, name: str, most: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: ``root`` is the smallest node of its component.

    A step is two aggregations and joins of the edges; a node with very many edges is split by the
    skew join. The edges stay in written tables; the driver sees a count and a checksum per round.
    """
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), name)
    mark = None
    for _ in range(most):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written first: the join of two exchanges can be split at a node with very many edges.
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), name)
        # Large star: every larger neighbour moves to the node's smallest neighbour.
        e = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(
            "u <> v").distinct()
        # Small star: the node and its smaller neighbours move to the smallest of them.
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        down = stored(down, name)
        low = stored(down.groupBy("u").agg(F.min("v").alias("m")), name)
        e = stored(down.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
            .filter("u <> v").distinct(), name)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
