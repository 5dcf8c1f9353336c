"""When requests may be made: a host is asked again only some time after it was asked last, and no request is made before it is ready."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import written


def wait_after(status: Column, attempt: Column, retry_after: Column, delay: int = 1000, backoff: float = 2.0) -> Column:
    """Milliseconds that a host is left alone after a request: what a 429 asks for, or else the backoff to the power of the attempt (from 0; one more for a 429 that names no time); the plain delay after a success."""
    power = lambda n: (F.pow(F.lit(backoff), n) * 1000).cast("long")
    return F.when(status == 429, F.coalesce((retry_after * 1000).cast("long"), power(attempt + 1))).when(status.isNull(), power(attempt)).otherwise(F.lit(delay).cast("long"))


def start_times(requests: DataFrame, host: str = "host", order: str = "ord") -> DataFrame:
    """requests (host, ord, ready, wait; milliseconds) with start: the later of ready and the start of the host's request before, plus its wait. ord must tell the requests of a host apart.

    Unrolled, a start is the sum of the waits before it plus the largest ready less the sum of the waits before that. So it is a running sum and a running maximum, and a hot host is cut into ranges:
    each is scanned alone, and the sums and maxima of those before it, one row for each range of a host, are put in front. Requests without a host are one host's.
    """
    parts = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(requests.repartitionByRange(parts, host, order).withColumns({"_range": F.spark_partition_id(), "_key": F.struct(host)}), "schedule-ranges")
    inside = Window.partitionBy("_range", "_key").orderBy(order)
    sums = ranged.withColumn("_before", F.coalesce(F.sum("wait").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    scanned = sums.withColumn("_most", F.max(F.col("ready") - F.col("_before")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    totals = scanned.groupBy("_range", "_key").agg(F.sum("wait").alias("_waits"), F.max(F.col("ready") - F.col("_before")).alias("_high"))
    earlier = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range of a host
    offset = totals.withColumn("_offset", F.coalesce(F.sum("_waits").over(earlier), F.lit(0)))
    carried = offset.select("_range", "_key", "_offset", F.max(F.col("_high") - F.col("_offset")).over(earlier).alias("_carried"))
    joined = scanned.join(carried, ["_range", "_key"])
    start = F.col("_offset") + F.col("_before") + F.greatest(F.col("_most") - F.col("_offset"), "_carried")
    return joined.withColumn("start", start.cast("long")).drop("_range", "_key", "_before", "_most", "_offset", "_carried")
