"""Connected components of an undirected graph by alternating large and small stars.

Edges only ever move towards smaller node numbers; each step is an aggregate (combined before the shuffle)
and a join, so a node with very many neighbours is never one group in one task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.session import stored


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v) with u > v; edges may come out more than once."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select("u", "v")
    # The smallest of a node and its neighbours; small stars look at smaller neighbours only.
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m")
    )
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # The neighbour and the node itself both move to the smallest.
        ends = F.array(F.col("v"), F.col("u"))
        moved = joined.select(F.explode(ends).alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of the edges ``u, v`` (longs), stored."""
    ordered = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stored(ordered.distinct(), "edges")
    while True:
        edges = stored(_step(_step(edges, large=True), large=False).distinct(), "stars")
        # Done when all edges are stars: no node has two centers, no center is below another.
        tops = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        centers = edges.select(F.col("v").alias("center")).distinct()
        loose = tops.join(centers, F.col("u") == F.col("center"), "left").filter("n > 1 OR center IS NOT NULL")
        if loose.isEmpty():
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return stored(
        edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
            roots.select("node", F.col("node").alias("component"))
        ),
        "components",
    )


def joined_components(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``components`` of the stored classes with more links ``u, v``; the same classes if there are none."""
    if links.isEmpty():
        return classes
    stars = classes.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return components(stars.filter("u <> v").unionByName(links.select("u", "v")))
