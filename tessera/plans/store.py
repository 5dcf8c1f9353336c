"""Sessions as a stored table: a log of versions, each a whole table, committed by putting the next number's entry where there is none.

A writer reads the newest version, writes the changed table under a name of its own, and puts the entry of the next version. If another was there first, the change is made again upon that one's
version, so no update is lost; readers see whole versions only.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import file_system
from ..tables import qualified
from . import sessions as S


def put_if_absent(spark: SparkSession, path: str, value: dict) -> bool:
    """Whether the file was put; False if one is there. Written aside first, so that it is whole when it appears."""
    uri = qualified(spark, path)
    fs, at = file_system(uri)
    aside = f"{at}.{uuid.uuid4().hex}.new"
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(aside, compression=None) as f:
        f.write(json.dumps(value).encode())
    try:
        if isinstance(fs, pyarrow.fs.LocalFileSystem):
            os.link(aside, at)
        else:  # a rename without the overwrite option fails if the target is there
            jvm = spark._jvm.org.apache.hadoop.fs
            jvm.FileContext.getFileContext(jvm.Path(uri).toUri(), spark._jsc.hadoopConfiguration()).rename(jvm.Path(f"{uri}{aside[len(at):]}"), jvm.Path(uri), spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0))
            return True
    except FileExistsError:
        return False
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    finally:
        if fs.get_file_info(aside).type != pyarrow.fs.FileType.NotFound:
            fs.delete_file(aside)
    return True


class SessionStore:
    """Dataset sessions (sessions.SESSION) in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def version(self) -> int:
        """The newest version; 0 before the first."""
        fs, root = file_system(qualified(self.spark, f"{self.folder}/log"))
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
        return max((int(x.base_name.removesuffix(".json")) for x in found if x.base_name.endswith(".json")), default=0)

    def entry(self, version: int) -> dict:
        fs, root = file_system(qualified(self.spark, f"{self.folder}/log"))
        with fs.open_input_stream(f"{root}/{version:012d}.json") as f:
            return json.loads(f.read())

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        return self.spark.read.schema(S.SESSION).parquet(self.entry(version)["path"]) if version else S.empty(self.spark)

    def commit(self, change: Callable[[DataFrame], DataFrame], what: str = "change", tries: int = 20) -> int:
        """The version that has the change, made upon the newest one; made again where another writer was faster."""
        for _ in range(tries):
            version = self.version()
            path = f"{self.folder}/data/{uuid.uuid4().hex}"
            change(self.read(version)).write.parquet(path)
            if put_if_absent(self.spark, f"{self.folder}/log/{version + 1:012d}.json", {"path": path, "what": what, "upon": version}):
                return version + 1
            fs, at = file_system(qualified(self.spark, path))
            fs.delete_dir(at)
        raise RuntimeError(f"{what}: {tries} other commits came first")

    def create(self, name: str, group_id: str | None = None) -> int:
        """A session of a group, or one of its own (group custom); its id."""
        made: list[int] = []

        def one(old: DataFrame) -> DataFrame:
            number = (old.agg(F.max("dataset_id")).first()[0] or 0) + 1
            made.append(number)
            shown = F.coalesce(F.nullif(F.trim(F.lit(name)), F.lit("")), F.lit(f"Dataset {number}"))
            new = self.spark.range(1).select(F.lit(number).cast("long").alias("dataset_id"), S.safe_name(shown).alias("name"), F.lit(group_id or "custom").alias("group_id"), F.lit("NOT_STARTED").alias("status"), S._pending().alias("stages"), F.current_timestamp().alias("updated_at"))
            return old.unionByName(new)

        self.commit(one, "create")
        return made[-1]

    def seed(self, groups: DataFrame) -> int:
        return self.commit(lambda old: S.seed(old, groups), "seed")

    def update(self, changes: DataFrame) -> int:
        """changes: (dataset_id, stage, status). A session that isn't there is an error."""

        def merged(old: DataFrame) -> DataFrame:
            if gone := changes.join(old, "dataset_id", "left_anti").first():
                raise KeyError(gone["dataset_id"])
            return S.update(old, changes)

        return self.commit(merged, "update")

    def refresh(self, artifacts: DataFrame) -> int:
        return self.commit(lambda old: S.refresh(old, artifacts), "refresh")
