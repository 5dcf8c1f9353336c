"""Training windows of binary shards as a data source: ranges of files are read by range, in an order of shards that differs from epoch to epoch; as a table or as a stream.

``spark.read.format("token_windows").option("path", folder).option("split", "train").load()`` gives epoch, turn, file, start, x and y: windows of seq_len + 1 tokens every seq_len, one that would end with
its shard exactly left out. Shards are ordered by the md5 of seed, epoch and name, windows by their place in the shard, and turn numbers them through the epoch. A partition is a run of windows of one
shard, so a task reads what it gives and a few tokens more, however large the shard. The stream gives some shards each micro-batch, in the same order; its offset is how many shards of all epochs have been given, so a stream
that is started again goes on where it was.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..tables import qualified
from .sinks import file_system

SCHEMA = "epoch int, turn bigint, file string, start bigint, x array<int>, y array<int>"
_NAMES = ["epoch", "turn", "file", "start", "x", "y"]


@dataclass
class WindowRange(InputPartition):
    """Windows `first` to `last` (not included) of a shard, and the turn of the first."""

    epoch: int
    turn: int
    file: str
    first: int
    last: int


_NOTHING = WindowRange(0, 0, "", 0, 0)


def windows_of(tokens: int, seq_len: int) -> int:
    """How many windows a shard has."""
    return max(0, -(-(tokens - seq_len - 1) // seq_len))


def shard_order(files: list[str], epoch: int, seed: int) -> list[str]:
    return sorted(files, key=lambda f: (hashlib.md5(f"{seed}|{epoch}|{f}".encode()).hexdigest(), f))


class _Shards:
    """The shards of a split, and how they are read. uri: the folder with its scheme."""

    def __init__(self, options: dict):
        self.uri, self.split = options["path"].rstrip("/"), options.get("split", "train")
        self.seq_len, self.epochs, self.seed = int(options.get("seq_len", 1024)), int(options.get("epochs", 1)), int(options.get("seed", 42))
        self.per_task, self.per_batch = int(options.get("windows_per_task", 4096)), int(options.get("shards_per_batch", 8))

    def manifest(self) -> dict:
        fs, root = file_system(self.uri)
        with fs.open_input_stream(f"{root}/{self.split}.manifest.json") as f:
            return json.loads(f.read())

    def ranges(self, start: int = 0, end: int | None = None) -> list[WindowRange]:
        """The ranges of the shards from number `start` to number `end` of all epochs' shards, one epoch after the other."""
        sizes = self.manifest()["files"]
        out, at = [], 0
        for epoch in range(self.epochs):
            turn = 0
            for file in shard_order(list(sizes), epoch, self.seed):
                n = windows_of(sizes[file], self.seq_len)
                if at >= start and (end is None or at < end):
                    out += [WindowRange(epoch, turn + k, file, k, min(k + self.per_task, n)) for k in range(0, n, self.per_task)]
                turn, at = turn + n, at + 1
        return out

    def read(self, part: WindowRange) -> Iterator[pa.RecordBatch]:
        if part.first == part.last:
            return
        width = self.manifest()["bits"] // 8
        fs, root = file_system(self.uri)
        begin, n = part.first * self.seq_len, (part.last - part.first) * self.seq_len + 1
        with fs.open_input_file(f"{root}/{part.file}") as f:
            tokens = np.frombuffer(f.read_at(n * width, begin * width), f"<u{width}").astype(np.int32)
        if len(tokens) < n:
            raise ValueError(f"{part.file} ends before its manifest says")
        count = part.last - part.first
        edges = pa.array(np.arange(count + 1, dtype=np.int32) * self.seq_len)
        columns = [
            pa.array(np.full(count, part.epoch, np.int32)), pa.array(part.turn + np.arange(count)), pa.array([part.file] * count, pa.string()), pa.array(begin + np.arange(count) * self.seq_len),
            pa.ListArray.from_arrays(edges, pa.array(tokens[:-1])), pa.ListArray.from_arrays(edges, pa.array(tokens[1:])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


class _Reader(DataSourceReader):
    def __init__(self, shards: _Shards):
        self.shards = shards

    def partitions(self) -> list[InputPartition]:
        return self.shards.ranges() or [_NOTHING]

    def read(self, partition: WindowRange) -> Iterator[pa.RecordBatch]:
        return self.shards.read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, shards: _Shards):
        self.shards, self.given = shards, 0

    def initialOffset(self) -> dict:
        return {"shards": 0}

    def latestOffset(self) -> dict:
        """Some shards beyond those given last, up to the end of the last epoch."""
        self.given = min(self.given + self.shards.per_batch, self.shards.epochs * len(self.shards.manifest()["files"]))
        return {"shards": self.given}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.given = max(self.given, end["shards"])
        return self.shards.ranges(start["shards"], end["shards"]) or [_NOTHING]

    def read(self, partition: WindowRange) -> Iterator[pa.RecordBatch]:
        return self.shards.read(partition)

    def commit(self, end: dict) -> None:
        pass


class TokenWindows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "token_windows"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Shards(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Shards(self.options))


def token_windows(spark: SparkSession, folder: str, stream: bool = False, **options):
    """The windows of a folder of shards (sinks.write_shards). Options: split, seq_len, epochs, seed, windows_per_task, shards_per_batch."""
    spark.dataSource.register(TokenWindows)
    read = (spark.readStream if stream else spark.read).format("token_windows").option("path", qualified(spark, folder))
    for name, value in options.items():
        read = read.option(name, str(value))
    return read.load()
