"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    pair = lambda a: F.struct(F.col(a).alias("u"), F.col("m").alias("v"))
    return edges.join(least, "u").select(F.explode(F.array(pair("v"), pair("u"))).alias("e")).select("e.*").where("u > v").distinct()


#: Edges that are few enough for one process: 16 MB.
FEW = 1 << 20


def _of_few(edges: pa.Table) -> pa.Table:
    """The components of a table of edges (u, v). In each round every root that has a smaller one beside it joins it, and paths are shortened to their roots."""
    nodes, at = np.unique(np.concatenate([edges.column("u").to_numpy(), edges.column("v").to_numpy()]), return_inverse=True)
    u, v = at[: edges.num_rows], at[edges.num_rows :]
    root = np.arange(len(nodes))
    while (root[u] != root[v]).any():
        a, b = root[u], root[v]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]
    return pa.table({"node": nodes, "component": nodes[root]})


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b) that has a neighbour; component is its smallest node.

    Each round is written to the shared folder, where the last one stays; the driver sees a count and a checksum of it. The centre of a large
    component is a frequent join key: minima are folded before the shuffle, and the skewed side of a join is split at run time (AQE). Edges that are FEW or less are solved by the driver at once.
    """
    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    mark = None
    while True:
        row = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if row == mark or not row[0]:
            break
        if row[0] <= FEW and now.dtypes == [("u", "bigint"), ("v", "bigint")]:
            spark, before = now.sparkSession, now
            solved = written(spark.createDataFrame(_of_few(before.toArrow())).coalesce(1), "components")
            discard(before)
            return solved
        mark, before = row, now
        now = written(_small_star(_large_star(before)), "edges")
        discard(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
