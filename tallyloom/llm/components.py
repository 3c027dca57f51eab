"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    leaves = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return leaves.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge, root being the least node of its component.

    ``edges`` has long columns u and v, in any direction, repeats and loops allowed. The stars
    shrink to depth one in a number of rounds that grows with the logarithm of the longest
    path. Every round is written to the shared folder, so a lost executor repeats one round at
    most. A node with very many edges meets only pre-aggregated minima and joins that adaptive
    execution can split. An empty edge table gives an empty result.
    """
    now = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        total, sums = now.select(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (total, sums) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = (total, sums)
        if not total:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = stored(_small_star(_large_star(now)).distinct(), "edges")
