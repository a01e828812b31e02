"""Connected components of a distributed edge list (alternating large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge (u, v) with the smallest node it reaches.

    Each round is written to the shared folder; a hub's edges are aggregated before they move and its join is
    an ordinary one that adaptive execution splits. The number of rounds is logarithmic in the longest path.
    """
    current, _ = written(edges.filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        current, _ = written(_small_star(_large_star(current)), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
