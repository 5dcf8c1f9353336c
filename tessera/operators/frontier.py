"""Breadth-first frontier over a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import written


def frontier(seeds: DataFrame, edges: DataFrame, max_depth: int = 3) -> DataFrame:
    """(url, depth): pages reachable from seeds (url) over edges (src, dst), each at its least depth; pages at max_depth aren't followed.

    One anti-join for each level against what was seen; each level is written, so plans stay short.
    """
    seen = written(seeds.select("url").distinct().withColumn("depth", F.lit(0)), "frontier")
    level = seen
    for depth in range(1, max_depth + 1):
        found = edges.join(level, edges["src"] == level["url"], "left_semi").select(F.col("dst").alias("url")).distinct()
        level = written(found.join(seen, "url", "left_anti").withColumn("depth", F.lit(depth)), "frontier")
        if level.isEmpty():
            break
        seen = written(seen.unionByName(level), "frontier")
    return seen


def upsert_seeds(existing: DataFrame, new: DataFrame) -> DataFrame:
    """existing, then the new seeds that it doesn't have; both (ord, url)."""
    fresh = new.join(existing, "url", "left_anti").groupBy("url").agg(F.min("ord").alias("ord")).withColumn("_new", F.lit(1))
    return existing.select("url", "ord", F.lit(0).alias("_new")).unionByName(fresh.select("url", "ord", "_new"))
