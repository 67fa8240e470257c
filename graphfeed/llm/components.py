"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphfeed.lineage import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least_neighbour(both), "u").filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least_neighbour(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (moved.unionByName(least.select("u", F.col("m").alias("v")))
            .filter(F.col("u") != F.col("v")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge ``u, v``; component is its least node.

    Large and small stars in turn until the edges stay as they are, which takes a number of
    rounds logarithmic in the number of nodes. Each round is a written table. No task holds more
    than single rows of a node, however many neighbours it has.
    """
    now = stored(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    mark = None
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or seen[0] == 0:
            # every node but the least of each component has one edge, to that least node
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = seen
