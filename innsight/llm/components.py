"""Connected components of a link table, by alternating star contractions.

Every round rewrites links so that each node points to its smallest neighbour; a path of length n shrinks to a star
in about log n rounds. Rounds are Spark joins and aggregates over the links; only a link count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours of a node go to its smallest neighbour. Small star: smaller ones and itself."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        out = (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(least.select("a", F.col("m").alias("b"))))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: longs, not null); component is the smallest node
    reachable. Links to itself and repeated links are harmless; no links give an empty result."""
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "links")
    while True:
        nxt = stored(_star(_star(now, large=True), large=False), "links")
        if nxt.count() == now.count() and nxt.join(now, ["a", "b"], "left_anti").isEmpty():
            break
        now = nxt
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
