"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import checkpointed

MOST_ROUNDS = 60


def stars(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node``, ``root``: every linked node but the smallest of its component, with that smallest one.

    Each round links a node's larger neighbours, then its smaller ones, to the
    smallest of them. The number of links never grows, and the rounds needed
    grow with the logarithm of the longest path. Each round's links are cut
    from their lineage in the checkpoint folder, so a lost executor costs one
    round at most. Nothing but counts goes to the driver.
    """
    edges = checkpointed(
        links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).filter("node <> root").distinct()
    )
    known = _signature(edges)
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.min("root").alias("low")).withColumn("low", F.least("low", "node"))
        large = both.filter("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("low").alias("root"))
        large = large.unionByName(least.filter("low < node").select("node", F.col("low").alias("root"))).distinct()
        low = large.groupBy("node").agg(F.min("root").alias("low"))
        small = large.join(low, "node")
        small = small.filter("root > low").select(F.col("root").alias("node"), F.col("low").alias("root")).unionByName(
            low.select("node", F.col("low").alias("root"))
        ).distinct()
        edges, before = checkpointed(small), known
        known = _signature(edges)
        if known == before:
            return edges
    raise RuntimeError("components did not settle")


def _signature(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("node", "root")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(hashed), F.sum(hashed.cast("decimal(38,0)"))).first())
