"""Connected components by alternating large and small stars over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seisgauge.sources.staging import stage

#: Far more rounds than any graph needs: their number grows with the logarithm of its size.
ROUNDS = 60


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's greater neighbours are linked to the least of it and its neighbours."""
    around = _both_ways(links)
    least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are linked to the least of these. Links run from the
    greater node to the lesser."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``u`` and ``v``: each node that has a link to a lesser one, and the least node it reaches.

    ``links`` has the long columns u and v, in any direction, with repeats and loops. Minima are
    combined in each task first, and joins on a hub are split by adaptive execution.
    """
    downward = links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    held = stage(downward.distinct(), "links")
    for _ in range(ROUNDS):
        if _settled(held):
            return held
        held = stage(_small_star(_large_star(held)), "links")
    raise RuntimeError("the components did not settle")


def _settled(links: DataFrame) -> bool:
    """Whether each node has one link, to a node that has none."""
    counts = links.agg(F.count("*"), F.count_distinct("u")).first()
    inner = links.join(links.select(F.col("u").alias("v")), "v", "left_semi")
    return counts[0] == counts[1] and not inner.take(1)
