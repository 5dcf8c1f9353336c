"""The crawl as a loop over tables: frontier, visited requests, read texts and the state of each domain.

A level is decided as a whole, in the order in which its requests were found: requests that rules, the domain's gate or its cap forbid are passed over, the others are fetched and read, the first
of equal texts stays, the gate latches and the cap counts within each domain, and the links of the pages that were admitted are the next level. Every table of a level is written
under a name of its own, and a level counts once its manifest names them all, so a crawl that lost a level goes on from the last whole one and comes to the same rows.

Defined cases: a request is visited once, at its least depth; pages at the last depth aren't followed; a text that was read once is a repetition ever after, whether its page was admitted or not;
null and empty pages have too few words; without seeds there are no pages.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions.scores import signal_score
from ..operators import html
from ..operators.dedup import first_of_each
from ..operators.gate import signal_gate
from ..sources.crawl import fetched_ok, robots_allow
from ..sources.sinks import file_system, write_json
from ..tables import qualified, running_total


@dataclass
class CrawlConfig:
    max_depth: int = 3
    pages_per_domain: int = 500
    max_bytes: int = 5_000_000
    least_words: int = 30
    gate_least: int = 10
    gate_threshold: float = 0.35
    gate_window: int = 20
    allow: tuple[str, ...] = ()
    score: Callable[[Column, Column], Column] = signal_score
    language: Callable[[Column], Column] | None = None  # of a text; other than "en" is left out, unknown stays


def fetched(requests: DataFrame, fetch: Callable[[str], tuple[int, str, str] | None], partitions: int | None = None) -> DataFrame:
    """(url, status, content_type, html) of what a fetch function returns for each url, or nothing; hosts stay together, so that one task asks a host."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [(u, *page) for u in pdf["url"] if (page := fetch(u)) is not None]
            yield pd.DataFrame(got, columns=["url", "status", "content_type", "html"])

    keyed = requests.select("url")
    placed = keyed.repartition(partitions, X.netloc(F.col("url"))) if partitions else keyed.repartition(X.netloc(F.col("url")))
    return placed.mapInPandas(run, "url string, status int, content_type string, html string")


_TABLES = {
    "visited": "url string, depth int, ord bigint, domain string, outcome string",
    "read": "url string, domain string, ord bigint, depth int, title string, text string, key string, score double, html string",
    "kept": "url string, ord bigint",
    "domains": "domain string, n bigint, shut boolean",
    "recent": "domain string, ord bigint, score double",
    "frontier": "url string, ord bigint",
}


class Crawl:
    """A crawl in a folder. fetch takes requests (url) and gives responses (url, status, content_type, html)."""

    def __init__(self, spark: SparkSession, folder: str, fetch: Callable[[DataFrame], DataFrame], config: CrawlConfig | None = None, robots: DataFrame | None = None):
        self.spark, self.folder, self.fetch, self.config, self.robots = spark, folder.rstrip("/"), fetch, config or CrawlConfig(), robots
        if self.config.gate_window < self.config.gate_least:
            raise ValueError("the gate's window must hold as many pages as it needs at least")
        self.levels = self._committed()

    def _committed(self) -> list[dict]:
        """Manifests of the whole levels, in order."""
        fs, root = file_system(qualified(self.spark, self.folder))
        out: list[dict] = []
        while True:
            try:
                with fs.open_input_stream(f"{root}/level-{len(out)}.json") as f:
                    out.append(json.loads(f.read()))
            except FileNotFoundError:
                return out

    def _write(self, df: DataFrame, level: int, name: str) -> tuple[str, DataFrame]:
        path = f"{self.folder}/level={level}/{name}-{uuid.uuid4().hex}"
        schema = _TABLES[name]
        columns = [c.split(" ") for c in schema.split(", ")]
        df.select(*[F.col(c).cast(t).alias(c) for c, t in columns]).write.parquet(path)
        return path, self.spark.read.schema(schema).parquet(path)

    def _tables(self, name: str) -> DataFrame:
        """The table of a name of all whole levels together."""
        paths = [x[name] for x in self.levels]
        return self.spark.read.schema(_TABLES[name]).parquet(*paths) if paths else self.spark.createDataFrame([], _TABLES[name])

    def _last(self, name: str) -> DataFrame:
        return self.spark.read.schema(_TABLES[name]).parquet(self.levels[-1][name]) if self.levels else self.spark.createDataFrame([], _TABLES[name])

    def _decided(self, front: DataFrame) -> DataFrame:
        """The frontier with domain, the domain's state, and why a request isn't made, if it isn't."""
        url, c = F.col("url"), self.config
        placed = front.withColumn("domain", X.registered_domain(url)).join(self._last("domains"), "domain", "left")
        ruled = placed.withColumn("outcome", F.when(~(X.public_http_url(url) & X.allowed_url(url, c.allow)), "blocked").when(F.coalesce("shut", F.lit(False)), "abandoned").when(F.coalesce("n", F.lit(0)) >= c.pages_per_domain, "capped"))
        if self.robots is not None:
            allowed = robots_allow(front.select("url"), self.robots).select("url", F.lit(True).alias("_allowed"))
            ruled = ruled.join(allowed, "url", "left").withColumn("outcome", F.coalesce("outcome", F.when(F.col("_allowed").isNull(), "blocked"))).drop("_allowed")
        return ruled

    def _read(self, asked: DataFrame, depth: int) -> DataFrame:
        """What the fetched pages hold: the parser's text, or the pattern's where that is too short."""
        pages = fetched_ok(self.fetch(asked.select("url")), self.config.max_bytes).select("url", "html")
        parsed = pages.withColumn("_x", html.extract(F.col("html")))
        enough = X.word_count(F.col("_x.text")) >= self.config.least_words
        text = parsed.select("url", "html", F.when(enough, F.col("_x.title")).otherwise(html.page_title(F.col("html"))).alias("title"), F.when(enough, F.col("_x.text")).otherwise(html.page_text(F.col("html"))).alias("text"))
        if self.config.language:
            text = text.where(F.coalesce(self.config.language(F.col("text")), F.lit("en")) == "en")
        scored = text.withColumns({"key": F.sha2("text", 256), "score": self.config.score(F.col("url"), F.col("text")), "depth": F.lit(depth)})
        return scored.join(asked.select("url", "domain", "ord"), "url")

    def _gated(self, first: DataFrame) -> DataFrame:
        """First texts of the level with admitted and bad: the gate goes on from the last pages of each domain, the cap from its count."""
        c = self.config
        carried = self._last("recent").select("domain", "ord", "score", F.lit(True).alias("carried"))
        both = first.select("domain", "ord", "score", F.lit(False).alias("carried")).unionByName(carried.join(first.select("domain"), "domain", "left_semi"))
        gated = signal_gate(both, least=c.gate_least, threshold=c.gate_threshold, window=c.gate_window)
        held = carried.groupBy("domain").agg(F.count("*").alias("held"))
        placed = gated.where("NOT carried").join(held, "domain", "left").join(self._last("domains").select("domain", "n"), "domain", "left")
        within = F.coalesce("n", F.lit(0)) + F.col("seq") - F.coalesce("held", F.lit(0)) <= c.pages_per_domain
        bad = (F.col("seq") >= c.gate_least) & (F.col("rolling") < c.gate_threshold)
        return placed.select("domain", "ord", "score", (F.col("admitted") & within).alias("kept"), F.when(~F.col("admitted"), "abandoned").when(~within, "capped").otherwise("kept").alias("fate"), bad.alias("bad"))

    def step(self) -> bool:
        """One level; whether there was one."""
        level, c = len(self.levels), self.config
        if not self.levels or level > c.max_depth + 1:
            return False
        front, depth = self._last("frontier"), level - 1
        if front.isEmpty():
            return False
        decided = self._decided(front.withColumn("depth", F.lit(depth)))
        paths: dict[str, str] = {}
        asked = decided.where("outcome IS NULL")
        paths["read"], read = self._write(self._read(asked, depth), level, "read")
        long = read.where(X.word_count(F.col("text")) >= c.least_words)
        before = self._tables("read").where(X.word_count(F.col("text")) >= c.least_words).select("key")
        first = first_of_each(long.select("url", "domain", "ord", "key", "score"), F.col("key"), "ord").join(before, "key", "left_anti")
        gated = self._gated(first)
        fates = read.select("url", "ord", (X.word_count(F.col("text")) >= c.least_words).alias("_long")).join(gated.select("ord", "fate"), "ord", "left").select("url", F.coalesce("fate", F.when(F.col("_long"), "repeated").otherwise("short")).alias("fate"))
        visited = decided.join(fates, "url", "left").withColumn("outcome", F.coalesce("outcome", "fate", F.lit("failed")))
        paths["visited"], visited = self._write(visited, level, "visited")
        paths["kept"], kept = self._write(visited.where("outcome = 'kept'"), level, "kept")
        marks = kept.select("ord").join(gated.select("domain", "ord", "score", "bad"), "ord")
        grown = marks.groupBy("domain").agg(F.count("*").alias("_more"), F.max("bad").alias("_bad")).join(self._last("domains"), "domain", "full")
        paths["domains"], _ = self._write(grown.select("domain", (F.coalesce("n", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("n"), (F.coalesce("shut", F.lit(False)) | F.coalesce("_bad", F.lit(False))).alias("shut")), level, "domains")
        last = Window.partitionBy("domain").orderBy(F.desc("ord"))  # a domain has no more pages than its cap
        recent = self._last("recent").unionByName(marks.select("domain", "ord", "score")).withColumn("_n", F.row_number().over(last)).where(F.col("_n") < c.gate_window)
        paths["recent"], _ = self._write(recent, level, "recent")
        paths["frontier"], _ = self._write(self._next(read, kept, visited) if depth < c.max_depth else front.limit(0), level, "frontier")
        self._commit(paths)
        return True

    def _next(self, read: DataFrame, kept: DataFrame, visited: DataFrame) -> DataFrame:
        """Links of admitted pages that were never asked for, numbered in the order in which they were found; what sitemaps name comes before the links of the seeds."""
        found = html.links_in_order(read.join(kept.select("url"), "url", "left_semi").select("url", "ord", "html"))
        if len(self.levels) == 1 and "sitemaps" in self.levels[0]:
            named = self.spark.read.schema(_TABLES["frontier"]).parquet(self.levels[0]["sitemaps"])
            found = found.unionByName(named.select(F.lit(-1).cast("long").alias("ord"), F.col("ord").alias("place"), F.col("url").alias("link")))
        seen = self._tables("visited").select("url").unionByName(visited.select("url"))
        fresh = found.groupBy(F.col("link").alias("url")).agg(F.min(F.struct("ord", "place")).alias("at")).join(seen, "url", "left_anti")
        return self._numbered(fresh.select("url", "at.ord", "at.place"), ["ord", "place"], seen.count())

    def _numbered(self, rows: DataFrame, order: list[str], start: int) -> DataFrame:
        keys = [f"_{c}" for c in order]
        renamed = rows.select("url", *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)], F.lit(1).alias("_one"))
        return running_total(renamed, keys, "_one", "_before").select("url", (F.col("_before") + start).alias("ord"))

    def _commit(self, paths: dict[str, str]) -> None:
        write_json(self.spark, f"{self.folder}/level-{len(self.levels)}.json", paths)
        self.levels.append(paths)

    def run(self, seeds: DataFrame, discovered: DataFrame | None = None) -> DataFrame:
        """(url, domain, depth, ord, title, text, score) of the admitted pages. seeds: (url, ord). discovered: (url, ord) of sitemaps, asked for with the links of the seeds.

        Level 0 holds the seeds; a crawl whose folder has levels goes on from them.
        """
        if not self.levels:
            paths = {name: self._write(self.spark.createDataFrame([], schema), 0, name)[0] for name, schema in _TABLES.items() if name != "frontier"}
            once = seeds.groupBy("url").agg(F.min("ord").alias("at"))
            paths["frontier"] = self._write(self._numbered(once, ["at"], 0), 0, "frontier")[0]
            if discovered is not None:
                paths["sitemaps"] = self._write(discovered.select("url", "ord"), 0, "frontier")[0]
            self._commit(paths)
        while self.step():
            pass
        return self.pages()

    def pages(self) -> DataFrame:
        return self._tables("read").join(self._tables("kept").select("url"), "url", "left_semi").select("url", "domain", "depth", "ord", "title", "text", "score")

    def visited(self) -> DataFrame:
        return self._tables("visited")
