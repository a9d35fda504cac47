"""Connected components of links in tables, by alternating large and small stars.

Each turn hangs every node below the smallest it knows: in a large star the
larger neighbours of a node, in a small star the smaller ones. The links become
stars around the smallest node of each component after a number of turns that
grows with the logarithm of the longest chain. Every turn is written to the
shared folder, which cuts the lineage. A node with very many links makes one
large key in joins only, which adaptive execution splits; minima are combined
before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.rows import settle


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes that occur in the links (a, b); root is the smallest node of the component."""
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = settle(links.where("a <> b").select(*ends).distinct(), "star")
    state = _state(now)
    while True:
        now = settle(_star(now, both=True), "star")
        now = settle(_star(now, both=False), "star")
        new = _state(now)
        if new == state:
            break
        state = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Links (a, b) with a > b; large star: neighbours on both sides, else the smaller ones only."""
    near = links.select(F.col("a").alias("node"), F.col("b").alias("next"))
    if both:
        near = near.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("next")))
    least = near.groupBy("node").agg(F.min("next").alias("least"))
    least = settle(least.select("node", F.least("node", "least").alias("least")), "least")
    met = near.join(least, "node")
    if both:
        out = met.where("next > node").select(F.col("next").alias("a"), F.col("least").alias("b"))
    else:
        out = met.where("next <> least").select(F.col("next").alias("a"), F.col("least").alias("b"))
        out = out.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.where("a <> b").distinct()
