"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geopanel.llm.common import shared_table


def _hang_on_least(pairs: DataFrame) -> DataFrame:
    """Beside each (u, v) the least v of u; u itself counts as one of them."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to its least neighbour."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _hang_on_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the least of them."""
    hung = _hang_on_least(links)
    return (
        hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(hung.select("u", F.col("m").alias("v")))
        .filter("u != v").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node of its component.

    ``links`` has two BIGINT columns; direction, repeats and loops do not matter. Each round
    is two aggregations and two joins on the node (a hub is an ordinary skewed join key) and
    is written to the shared folder. Rounds end when the links no longer change, after a
    number that grows with the logarithm of the longest chain.
    """
    a, b = links.columns
    now = shared_table(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u != v").distinct(), "links")
    seal = None
    while True:
        new = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
                      .alias("s")).first()
        if new == seal or not new["n"]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seal = new
        now = shared_table(_small_star(_large_star(now)), "links")
