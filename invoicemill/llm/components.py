"""Connected components by alternating stars, for any number of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from invoicemill.session import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least node around it. Links run from the greater (u) to the less (v)."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable. Nodes without a link are not listed.

    ``links`` has the integer columns u and v in either order. Each round is written to the shared folder, so a lost
    executor costs one round; one row per round reaches the driver. A node with very many links is summed map-side and its
    links are split by adaptive execution.
    """
    links = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(links)
    while state[0]:
        links = written(_small_star(_large_star(links)), "stars")
        after = _state(links)
        if after == state:
            break
        state = after
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
