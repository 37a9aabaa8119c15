"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import Scratch


def _smallest(sym: DataFrame) -> DataFrame:
    """For each node its smallest neighbour or itself (partial aggregate before the shuffle)."""
    return sym.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _large_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (written)."""
    sym = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    m = scratch.keep(_smallest(sym), "large-min")
    # ``m`` is read from a table, so a hub's rows can be split over tasks in this join
    out = scratch.keep(sym.where("v > u").join(m, "u").where("v <> m")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
    scratch.drop(m)
    return out


def _small_star(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them (written)."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    m = scratch.keep(_smallest(down), "small-min")
    tied = down.join(m, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = scratch.keep(tied.union(m.where("u <> m").select("u", F.col("m").alias("v"))).distinct(), "small")
    scratch.drop(m)
    return out


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, component) for each node of ``edges`` (u, v), component its smallest member.

    Both steps keep the components and strictly shrink what is not yet a star; the loop
    ends when a round changes nothing (count and an order-free digest of the edges agree).
    Nothing but those two numbers reaches the driver.
    """
    cur = scratch.keep(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                       F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if mark == seen:
            return cur.select("u", F.col("v").alias("component")).union(
                cur.select(F.col("v").alias("u"), F.col("v").alias("component"))).distinct()
        seen = mark
        large = _large_star(cur, scratch)
        small = _small_star(large, scratch)
        scratch.drop(cur, large)
        cur = small
