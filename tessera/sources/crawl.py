"""What a crawl decides with before and after a fetch, as filters and ranks over tables of requests and responses, and a source of pages.

Fetching itself is a boundary: ``PageSource`` reads what a fetch function returns for each url, and the offline one looks it up in a table.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import expressions as X


def fetched_ok(responses: DataFrame, max_bytes: int = 5_000_000) -> DataFrame:
    """Responses (status, content_type, html) that hold a page: status 200, HTML or plain text, not too large."""
    kind = F.lower(F.coalesce("content_type", F.lit("")))
    return responses.where((F.col("status") == 200) & (kind.contains("text/html") | kind.contains("text/plain")) & (F.coalesce(F.octet_length("html"), F.lit(0)) <= max_bytes))


def robots_allow(requests: DataFrame, rules: DataFrame, agent: str = "*") -> DataFrame:
    """Requests (url) that no robots rule forbids. rules: (host, agent, allow, prefix); the longest prefix decides, allow among equals."""
    path = F.coalesce(F.nullif(X.url_path(F.col("url")), F.lit("")), F.lit("/"))
    asked = requests.withColumn("_host", X.netloc(F.col("url"))).withColumn("_path", path)
    own = rules.where(F.col("agent").isin(agent, "*")).select(F.col("host").alias("_host"), F.col("allow").alias("_allow"), F.col("prefix").alias("_prefix"))
    hit = asked.select("url", "_host", "_path").distinct().join(own, "_host").where(F.col("_path").startswith(F.col("_prefix")))
    best = hit.groupBy("url").agg(F.max(F.struct(F.length("_prefix").alias("n"), F.col("_allow").cast("int").alias("a"))).alias("best"))
    return asked.join(best.where("best.a = 0").select("url"), "url", "left_anti").drop("_host", "_path")


def english(language: Column, permissive: bool = True) -> Column:
    """Documents in English; unknown languages pass if permissive."""
    return F.coalesce(language == "en", F.lit(permissive))


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    """The first `most` rows of each group in an order: repositories by stars, papers by date, issues by comments, results of a query."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def unseen(requests: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    """Requests whose key wasn't seen before."""
    return requests.dropDuplicates([key]).join(seen.select(key), key, "left_anti")


class _Urls(InputPartition):
    def __init__(self, urls: list[str]):
        self.urls = urls


class _PageReader(DataSourceReader):
    def __init__(self, urls: list[str], fetch, size: int):
        self.urls, self.fetch, self.size = urls, fetch, size

    def partitions(self) -> list[InputPartition]:
        return [_Urls(self.urls[i : i + self.size]) for i in range(0, len(self.urls), self.size)] or [_Urls([])]

    def read(self, partition: _Urls) -> Iterator[tuple]:
        for url in partition.urls:
            page = self.fetch(url)
            if page is not None:
                yield (url, int(page[0]), page[1], page[2])


def page_source(name: str, fetch, size: int = 100) -> type[DataSource]:
    """A data source of that name: option "urls" (one a line) gives rows (url, status, content_type, html) of what fetch(url) returns as a triple or None."""

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "url string, status int, content_type string, html string"

        def reader(self, schema) -> DataSourceReader:
            return _PageReader([u for u in self.options.get("urls", "").split("\n") if u.strip()], fetch, size)

    return PageSource
