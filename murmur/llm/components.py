"""Connected components of a link table, by rounds of stars, all in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import settled


def _smallest(links: DataFrame) -> DataFrame:
    """A table of its own, as adaptive execution splits a hub's links only where both sides come straight from a shuffle."""
    return settled(links.groupBy("u").agg(F.min("v").alias("m")), "smallest")


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest of it and its neighbours."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = _smallest(down)
    moved = down.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (u, v) that isn't its component's smallest; root is that smallest.

    Rounds end when the links no longer change, after a few more than the logarithm of the
    longest chain. Each round is a table in the shared folder; only a count and a checksum
    reach the driver. A hub's links are many rows of one key on one side of a join whose
    other side has one row for a key, which adaptive execution splits.
    """
    links = settled(_small_star(links.select("u", "v").where("u != v")), "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(state)
        links = settled(_small_star(_large_star(links)), "links")
