"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaextract.llm.common import checkpointed


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for all nodes of ``links`` (``a``, ``b``); self-links name single nodes.

    Large-star and small-star rounds: every node hands its neighbours its least neighbour, until the links are stars. Minima are combined
    before they are shuffled, and a node with very many links is a skewed join key, which Spark splits.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    stars = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    for _ in range(rounds):
        stars = checkpointed(_small(_large(stars)))
        # Links only ever point to smaller nodes; once neither their number nor the sum of their hashes changes, they are stars.
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"links did not settle in {rounds} rounds")
    return nodes.join(stars.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _large(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()
