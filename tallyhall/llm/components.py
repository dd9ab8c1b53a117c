"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _print(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root): every node that ``links`` (columns a, b) names, and
    the smallest node that it reaches.

    Large-star and small-star rounds in turn: each links a node's larger
    neighbours, then its smaller ones, to the smallest of them, until nothing
    changes.  A node's neighbours are never gathered, only their minimum, so
    a node with many links is a partial aggregate and a join that Spark may
    split.  Each round is written to the shared folder."""
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _print(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        large = saved(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        edges = saved(small.select(F.col("b").alias("a"), F.col("low").alias("b"))
                      .union(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "small-star")
        now = _print(edges)
        if now == seen:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
