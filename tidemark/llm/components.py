"""Connected components by alternating stars, on staged edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Every node tells its larger neighbours about the least node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """Every node (a > b) hands its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    handed = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node (a > b) has one smaller neighbour, which has none itself. No edges are stars, too."""
    roles = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    )).alias("r")).select("r.*")
    counted = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.filter("up > 1 OR (up = 1 AND down = 1)").agg(F.count(F.lit(1))).first()[0] == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; the component is its least node.

    ``edges`` has two columns of one orderable type, in any direction, repeats
    and loops allowed. Rounds grow with the logarithm of a component's
    diameter, and stars need none; each is written to the shared folder, so a lost executor costs
    one round. Minima are combined before the shuffle, and the joins on a node
    with very many neighbours are inner joins that adaptive execution splits.
    """
    first, second = edges.columns
    now = stage(
        edges.filter(f"`{first}` <> `{second}`")
        .select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).distinct(),
        "edges",
    )
    while not _are_stars(now):
        now = stage(_smaller_to_least(_larger_to_least(now)), "stars")
    stars = now.groupBy("a").agg(F.min("b").alias("component"))
    roots = stars.select(F.col("component").alias("a")).distinct().withColumn("component", F.col("a"))
    return stars.unionByName(roots).withColumnRenamed("a", "node")
