"""Tables in the folder that driver and executors share, and running totals over whole tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a folder of this session if driver and tasks are one process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tessera-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark takes it to have, for those who open files by themselves."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return "file://" + full[len("file:") :] if full.startswith("file:/") and not full.startswith("file://") else full


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """The rows as a Parquet table, read again: lineage ends here and lost executors cost nothing. group_bytes bounds what a task holds of a table whose rows are megabytes: Parquet else looks at the size of a group after 100 rows first."""
    path, writer = new_path(df.sparkSession, name), df.write
    if group_bytes:
        writer = writer.options(**{"parquet.block.size": group_bytes, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1})
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the files of written tables that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(scan: DataFrame) -> DataFrame:
    """A scan dealt out to all cores where its files give fewer tasks than there are cores; larger tables are left as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def running_total(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """df with the sum of value over all rows before each, in order, in two levels: sums of ranges, then sums inside a range.

    No task sees more than one range; only one row for each range is gathered. order must tell rows apart.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(F.broadcast(offsets), "_range")
    return joined.withColumn(name, (F.col("_offset") + F.col("_inside")).cast("long")).drop("_range", "_offset", "_inside")
