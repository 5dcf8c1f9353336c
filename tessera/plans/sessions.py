"""Dataset sessions as a table: creation, seeding from groups, updates, ingest manifests."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expressions import safe_name
from ..operators.reports import STAGES
from ..sources.readers import file_tree
from ..sources.sinks import CHUNK, file_system
from ..tables import qualified, written

SESSION = "dataset_id bigint, name string, group_id string, status string, stages map<string,string>, updated_at timestamp"


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SESSION)


def _pending() -> Column:
    return F.create_map(*(x for s in STAGES for x in (F.lit(s), F.lit("pending"))))


def seed(sessions: DataFrame, groups: DataFrame) -> DataFrame:
    """sessions, and one for each group (ord, group_id, name) that has none, numbered on from the largest id in the groups' order.

    Groups are a configuration's few, so one task ranks them.
    """
    fresh = groups.join(sessions.select("group_id"), "group_id", "left_anti")
    last = sessions.agg(F.max("dataset_id")).first()[0] or 0
    numbered = fresh.withColumn("_n", F.row_number().over(Window.orderBy("ord")))
    made = numbered.select((F.col("_n") + last).cast("long").alias("dataset_id"), safe_name(F.col("name")).alias("name"), "group_id", F.lit("COLLECTED").alias("status"), _pending().alias("stages"), F.lit(None).cast("timestamp").alias("updated_at"))
    return sessions.unionByName(made)


def update(sessions: DataFrame, changes: DataFrame) -> DataFrame:
    """sessions with the stage statuses of changes (dataset_id, stage, status) merged in."""
    new = changes.groupBy("dataset_id").agg(F.map_from_entries(F.collect_list(F.struct("stage", "status"))).alias("_new"))
    joined = sessions.join(new, "dataset_id", "left")
    kept = F.map_filter("stages", lambda k, _: ~F.coalesce(F.map_contains_key(F.col("_new"), k), F.lit(False)))
    return joined.withColumn("stages", F.when(F.col("_new").isNull(), F.col("stages")).otherwise(F.map_concat(kept, "_new"))).withColumn("updated_at", F.when(F.col("_new").isNotNull(), F.current_timestamp()).otherwise(F.col("updated_at"))).drop("_new")


def stage_rows(sessions: DataFrame) -> DataFrame:
    """(dataset_id, stage, status) for reports.session_state."""
    return sessions.select("dataset_id", F.explode("stages").alias("stage", "status"))


def ingest(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Manifest rows (path, source, sha256, size, collected_at) of a file tree."""
    return file_tree(spark, path).select("path", F.lit(source).alias("source"), "sha256", "size", F.current_timestamp().alias("collected_at"))


_COPIED = "path string, source string, sha256 string, size bigint, attempt string, error string"


def copy_in(files: DataFrame, root: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """(manifest, errors) of files (path) below root, copied into folder: manifest has path, source, sha256, size and collected_at, errors source and error.

    A task copies its files a chunk at a time under names of its attempt; when all are copied, a second pass puts those whose rows count into their places. A file that can't be read gives an error row and
    the others arrive; copies of attempts that failed are removed at the end. Paths below root are kept; a path that is there already is replaced.
    """
    spark = files.sparkSession
    base, target = qualified(spark, root).rstrip("/"), qualified(spark, folder).rstrip("/")
    aside = f"{target}/.incoming-{uuid.uuid4().hex}"

    def copy(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to, into = file_system(aside)
        to.create_dir(into, recursive=True)
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                full = "file://" + path[len("file:") :] if path.startswith("file:/") and not path.startswith("file://") else path
                attempt, digest, size, error = uuid.uuid4().hex, hashlib.sha256(), 0, None
                try:
                    if not full.startswith(f"{base}/"):
                        raise ValueError(f"not below {base}")
                    own, at = file_system(full)
                    with own.open_input_stream(at) as source, to.open_output_stream(f"{into}/{attempt}", compression=None) as sink:
                        while chunk := source.read(CHUNK):
                            sink.write(chunk)
                            digest.update(chunk)
                            size += len(chunk)
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                out.append((full[len(base) + 1 :], path, digest.hexdigest(), size, attempt, error))
            yield pd.DataFrame(out, columns=["path", "source", "sha256", "size", "attempt", "error"])

    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to, into = file_system(aside)
        home = file_system(target)[1]
        for pdf in batches:
            for path, attempt in zip(pdf["path"], pdf["attempt"], strict=True):
                to.create_dir(f"{home}/{path}".rsplit("/", 1)[0], recursive=True)
                if to.get_file_info(f"{into}/{attempt}").type != pyarrow.fs.FileType.NotFound:  # else this row was placed by an attempt before
                    to.move(f"{into}/{attempt}", f"{home}/{path}")
            yield pdf[["path"]]

    copied = written(files.select("path").distinct().mapInPandas(copy, _COPIED), "copied")
    arrived = copied.where("error IS NULL")
    arrived.select("path", "attempt").mapInPandas(place, "path string").write.format("noop").mode("overwrite").save()
    fs, at = file_system(aside)
    if fs.get_file_info(at).type != pyarrow.fs.FileType.NotFound:
        fs.delete_dir(at)
    return arrived.select("path", "source", "sha256", "size", F.current_timestamp().alias("collected_at")), copied.where("error IS NOT NULL").select("source", "error")


def refresh(sessions: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Stages with an artifact (dataset_id, stage) are complete."""
    return update(sessions, artifacts.select("dataset_id", "stage", F.lit("complete").alias("status")).distinct())
