"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import land


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(low.select("u", F.least("u", "m").alias("m")), "u")
            .where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(low, "u")
    return (joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct())


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that occurs in ``links``; ``root`` is the
    smallest node of its component. Self-links and NULL ends are ignored.

    Every round is two grouped minima and two joins on the node; it stops
    when the link set no longer changes (O(log^2 n) rounds), and each round's
    links are written to the shared folder. Nothing is collected but one
    checksum per round. A hub holding many links is a skewed join key, which
    adaptive execution splits."""
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u is not null and v is not null and u != v").distinct())
    edges = land(edges, "cc-links")
    last = None
    for _ in range(max_rounds):
        edges = land(_small_star(_large_star(edges)), "cc-round")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")))
                    .distinct())
        last = now
    raise RuntimeError(f"links did not settle in {max_rounds} rounds")
