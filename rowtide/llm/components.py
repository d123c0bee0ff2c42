"""Connected components of a link table, as alternating star joins.

Each round rewires every node to the smallest node it can see (large star),
then flattens the trees that this makes (small star); a component ends as one
star around its smallest node. Rounds grow with the logarithm of the longest
chain. The table is written to the shared folder after each step, so lineage
stays short; minima are aggregated before they are shuffled, and the join back
on the hub is a plain shuffle join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.io import settle


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = settle(both.groupBy("a").agg(F.min("b").alias("m")), "large-star")
    low = low.select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = settle(down.groupBy("a").agg(F.min("b").alias("m")), "small-star")
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """Links (columns ``a``, ``b``; any order, repeats allowed, nulls and
    self-links ignored) to (``node``, ``root``): every linked node with the
    smallest node of its component. The root itself is listed too."""
    links = settle(links.select("a", "b").where("a <> b").distinct(), "links")
    seen = None
    while True:
        links = settle(_small_star(settle(_large_star(links), "links")), "links")
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
        if state == seen:
            break
        seen = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
