"""Signal gate over domains: a rolling mean that latches, and a cap on pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import written


def signal_gate(pages: DataFrame, domain: str = "domain", score: str = "score", order: str = "ord", least: int = 10, threshold: float = 0.35, window: int = 20) -> DataFrame:
    """pages with seq, rolling and admitted: once the mean of the last `window` scores falls below the threshold after `least` pages, later pages of the domain are out.

    A large domain is cut into ranges of the order. Counts and first bad pages of earlier ranges come from one row for each range and domain, and the
    pages that the mean looks back to are copied on, so no task sees more than a range and a few pages. order must tell the pages of a domain apart.
    """
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(pages.repartitionByRange(parts, domain, order).withColumn("_range", F.spark_partition_id()).withColumn("_key", F.struct(domain)), "gate-ranges")
    back, key = window - 1, ["_range", "_key"]  # structs of nulls are equal, so pages without a domain are one, too
    last = ranged.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).where(F.col("_n") <= back).drop("_n")
    # A range between two others of a domain has a page of it at least, so the pages looked back to lie in the `back` ranges before.
    carried = last.withColumn("_range", F.explode(F.transform(F.sequence(F.lit(1), F.lit(max(back, 1))), lambda k: F.col("_range") + k))).withColumn("_own", F.lit(False))
    both = ranged.withColumn("_own", F.lit(True)).unionByName(carried.join(ranged.select(*key).distinct(), key, "left_semi"))
    inside = Window.partitionBy(*key).orderBy(order)
    rolled = both.withColumn("rolling", F.avg(score).over(inside.rowsBetween(-back, 0))).where("_own").drop("_own").withColumn("_in", F.row_number().over(inside))
    counts = ranged.groupBy(*key).agg(F.count("*").alias("_count"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range of a domain
    before = counts.select(*key, F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_before"))
    placed = written(rolled.join(before, key).withColumn("seq", (F.col("_before") + F.col("_in")).cast("int")).drop("_before", "_in"), "gate-places")
    bad = F.when((F.col("seq") >= least) & (F.col("rolling") < threshold), F.col("seq"))
    firsts = placed.groupBy(*key).agg(F.min(bad).alias("_bad")).select(*key, F.min("_bad").over(earlier).alias("_shut"))
    here = F.min(bad).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    out = placed.join(firsts, key).withColumn("admitted", F.coalesce(F.col("seq") <= F.least("_shut", here), F.lit(True)))
    return out.drop("_range", "_key", "_shut")


def domain_cap(pages: DataFrame, most: int, domain: str = "domain", order: str = "ord") -> DataFrame:
    """The first `most` pages of each domain."""
    return pages.withColumn("_n", F.row_number().over(Window.partitionBy(domain).orderBy(order))).where(F.col("_n") <= most).drop("_n")


def abandoned(gated: DataFrame, domain: str = "domain", least: int = 10, threshold: float = 0.35) -> DataFrame:
    """Domains that the gate shut."""
    return gated.where((F.col("seq") >= least) & (F.col("rolling") < threshold)).select(domain).distinct()
