"""Structured Streaming forms: first-seen texts, the signal gate, event-time windows and sessions."""

from __future__ import annotations

import json
import uuid
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import expressions as X
from ..operators import dedup
from ..operators.components import components
from ..sources.sinks import file_system, write_json
from ..tables import qualified


def event_time(df: DataFrame, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Watermarks need a time with a zone; columns without one are taken as the session's."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def first_seen(docs: DataFrame, key_text: str = "text", ts: str = "ts", late: str | None = None) -> DataFrame:
    """Rows whose text wasn't seen before, over all batches; the state has a key for each different text.

    With `late`, a bound on the state: a row is dropped if its text was first seen within `late` before it, and a key is forgotten once the watermark is `late` past it, so a text that comes again after that
    may be given again.
    """
    keyed = docs.withColumn("_key", X.exact_key(F.col(key_text)))
    return keyed.dropDuplicates(["_key"]).drop("_key") if late is None else event_time(keyed, ts, late).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def tumbling_counts(events: DataFrame, width: str = "5 minutes", slide: str | None = None, by: str = "event_type") -> DataFrame:
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    return event_time(events).groupBy(w, by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", by: str = "user_id") -> DataFrame:
    return event_time(events).groupBy(F.session_window("ts", gap), by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


_STATE = T.StructType([T.StructField("n", T.LongType()), T.StructField("last", T.ArrayType(T.DoubleType())), T.StructField("shut", T.BooleanType())])


def gate(pages: DataFrame, domain: str = "domain", score: str = "score", order: str = "ord", least: int = 10, threshold: float = 0.35, window: int = 20, chunk: int = 50_000) -> DataFrame:
    """(domain, ord, admitted) by the latching gate. State is the last `window` scores of each domain; rows of a batch are taken in order.

    Of a domain's rows in a micro-batch a task holds the orders and scores, 16 bytes a row, which it must sort; it gives them on in chunks, and once the gate is shut nothing more is computed.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, last, shut = state.get if state.exists else (0, [], False)
        held = deque(last, window)
        parts = [(b[order].to_numpy(), b[score].to_numpy(float)) for b in batches]
        orders, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        by_order = np.argsort(orders, kind="stable")
        open_until = 0  # rows of the batch that are admitted
        if not shut:
            open_until = len(orders)
            for k, at in enumerate(by_order.tolist()):
                held.append(float(scores[at]))
                if n + k + 1 >= least and sum(held) / len(held) < threshold:
                    shut, open_until = True, k + 1
                    break
        state.update((n + len(orders), list(held), shut))
        for start in range(0, len(orders), chunk):
            own = by_order[start : start + chunk]
            yield pd.DataFrame({"domain": [key[0]] * len(own), "ord": orders[own], "admitted": np.arange(start, start + len(own)) < open_until})

    return pages.groupBy(domain).applyInPandasWithState(run, "domain string, ord bigint, admitted boolean", _STATE, "append", GroupStateTimeout.NoTimeout)


def buffered_dedup(docs: DataFrame, path: str, checkpoint: str, threshold: float | Callable[[], float] = 0.92):
    """A stream whose batches are each freed of near copies, a folder of path for each batch, which a batch that is tried again replaces. A threshold that is a function is asked anew for every batch, so settings may change while the stream runs."""

    def one(batch: DataFrame, batch_id: int) -> None:
        best = dedup.best_of_clusters(batch, dedup.jaccard_clusters(batch, threshold() if callable(threshold) else threshold))
        best.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return docs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)


class NearCopyIndex:
    """Near copies across the batches of a stream: texts, the prefix shingles and sketches of their sets, members and links, as tables in a folder that grow by a part for each batch.

    A batch holds its new shingle sets against all sets that came before and against each other; sets that are there already only gain members. Its part counts once its manifest names all its tables, and a
    batch that has one is passed over, so trying it again changes nothing. The order of rarity that prefixes follow is that of the first batch, kept beside the parts: any order finds all pairs if it is one for all. Ids must tell rows apart.
    Texts are kept lower-cased and compressed, and sets are made from them where they are compared: a set takes several times the room of its text.
    """

    _TABLES = {"members": "id bigint, key string", "texts": "id bigint, text string", "heads": "key string, rep bigint, n int, head array<bigint>, sketch binary", "links": "a bigint, b bigint"}

    def __init__(self, spark: SparkSession, folder: str, threshold: float = 0.92, n: int = 3):
        self.spark, self.folder, self.threshold, self.n = spark, folder.rstrip("/"), threshold, n

    def _json(self, name: str) -> dict | None:
        fs, root = file_system(qualified(self.spark, self.folder))
        try:
            with fs.open_input_stream(f"{root}/{name}.json") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def _parts(self) -> list[dict]:
        fs, root = file_system(qualified(self.spark, self.folder))
        found = fs.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
        names = sorted(x.base_name.removesuffix(".json") for x in found if x.base_name.startswith("batch-") and x.base_name.endswith(".json"))
        return [self._json(x) for x in names]

    def table(self, name: str) -> DataFrame:
        """The parts of all whole batches together."""
        paths = [x[name] for x in self._parts()]
        return self.spark.read.schema(self._TABLES[name]).parquet(*paths) if paths else self.spark.createDataFrame([], self._TABLES[name])

    def _order(self, counted: DataFrame) -> np.ndarray:
        kept = self._json("order")
        if kept is None:
            kept = {"shingles": dedup.most_frequent(counted).tolist()}
            write_json(self.spark, f"{self.folder}/order.json", kept)
        return np.array(kept["shingles"], np.int64)

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """batch: doc_id, text. Does nothing if the batch is there already."""
        if self._json(f"batch-{batch_id:012d}") is not None:
            return
        before = {name: self.table(name) for name in self._TABLES}
        at = {name: f"{self.folder}/{name}/{uuid.uuid4().hex}" for name in self._TABLES}

        def put(name: str, df: DataFrame) -> DataFrame:
            df.write.option("compression", "zstd").parquet(at[name])
            return self.spark.read.schema(self._TABLES[name]).parquet(at[name])

        own = put("texts", dedup.lowered(batch, "doc_id"))
        digests, counted = dedup.digested(own, self.n)
        put("members", batch.select(F.col("doc_id").alias("id")).join(digests, "id", "left"))
        firsts = digests.groupBy("key").agg(F.min("id").alias("rep")).join(before["heads"].select("key"), "key", "left_anti")
        made = dedup.Texts(own, self.n).heads(self._order(counted), self.threshold)
        fresh = put("heads", made.join(firsts, "rep").select("key", "rep", "n", "head", "sketch"))
        every = before["heads"].unionByName(fresh)
        texts = dedup.Texts(before["texts"].unionByName(own), self.n)
        put("links", dedup.jaccard_links(dedup.listed(every), texts, self.threshold, before["links"], fresh.select("rep"), sketches=every))
        write_json(self.spark, f"{self.folder}/batch-{batch_id:012d}.json", at)

    def clusters(self) -> DataFrame:
        """(id, cluster) of every document so far: the smallest id among those reachable; documents without tokens stand alone."""
        found = components(self.table("links"))
        named = self.table("members").join(self.table("heads").select("key", "rep"), "key", "left").join(found, F.col("rep") == F.col("node"), "left").select("id", F.coalesce("component", "rep").alias("group"))
        least = named.where("group IS NOT NULL").groupBy("group").agg(F.min("id").alias("cluster"))
        return named.join(least, "group", "left").select("id", F.coalesce("cluster", "id").alias("cluster"))

    def of_stream(self, docs: DataFrame, checkpoint: str):
        """A stream of (doc_id, text) into the index."""
        return docs.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint)
