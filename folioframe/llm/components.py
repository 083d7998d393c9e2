"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.session import cut, discard


def _directed(links: DataFrame) -> DataFrame:
    """Links as ``(u, v)`` with ``u > v``, each once."""
    return links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest of the node's neighbourhood."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    pulled = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return pulled.union(least.select("u", F.col("m").alias("v")))


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every linked node has one link, to a node that has none to a smaller one."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(u, v)``; a component is its smallest node.

    Links may repeat, point either way and loop. A node of loops alone isn't returned. Each round
    is written to the shared folder, and only whether it is done comes to the driver. Rounds grow
    with the logarithm of the longest path.
    """
    held, path = cut(_directed(links), "links")
    while not _is_star_forest(held):
        stars, star_path = cut(_directed(_small_star(_directed(_large_star(held)))), "stars")
        discard(links.sparkSession, path)
        held, path = stars, star_path
    smallest = held.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(smallest)
