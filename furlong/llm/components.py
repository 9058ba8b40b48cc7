"""Connected components by alternating large-star and small-star steps over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, stage


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: each node's neighbours (the larger ones, or the smaller ones with itself) point to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the least node reachable. Each step is written, so no lineage grows; self-loops and repeated edges do no harm."""
    now = stage(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        after = stage(star(star(now, True), False), "edges")
        drop(now)
        now = after
        seen = tuple(now.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
        if seen == state:
            break
        state = seen
    out = now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    out.staged_path = now.staged_path
    return out
