"""Sources: lists, JSON lines, pages, datasets, repositories, papers, shards and file trees as DataFrames."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as X
from ..functions import values as V
from ..functions.scores import apply_weights, citation_bonus, signal_score, star_bonus
from ..schema import DOCUMENT, as_documents
from ..tables import written


def text_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file without blanks and # comments."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    return spark.read.text(path).select(line.alias("url")).where("url <> '' AND NOT url LIKE '#%'")


def json_lines(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Document rows; FAILFAST stops at the first malformed line, DROPMALFORMED skips them. Rows without an id are malformed."""
    if mode == "PERMISSIVE":
        read = spark.read.schema(DOCUMENT.add("_corrupt_record", "string") if "_corrupt_record" not in DOCUMENT.names else DOCUMENT)
        return read.option("mode", mode).json(path)
    rows = as_documents(spark.read.schema(DOCUMENT).option("mode", mode).json(path))
    if mode == "FAILFAST":
        return rows.withColumn("doc_id", F.coalesce("doc_id", F.raise_error(F.lit("a row has no doc_id")).cast("string")))
    return rows.where("doc_id IS NOT NULL")


def corpus_texts(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty texts for sharding; an empty corpus is an error."""
    out = json_lines(spark, path).select("text").where("text <> ''")
    if out.isEmpty():
        raise ValueError(f"no text in {path}")
    return out


def page_documents(pages: DataFrame, least_words: int = 30, max_bytes: int = 5_000_000) -> DataFrame:
    """Pages (page_id, url, html) as documents: size and word gates, the parser's text or else the pattern's, first of equal texts, types, signal score and weights."""
    from ..operators.dedup import exact_dedup
    from ..operators.html import best_text, page_title

    fit = pages.where(F.coalesce(F.octet_length("html"), F.lit(0)) <= max_bytes)
    read = written(fit.select(F.col("page_id").alias("ord"), "url", page_title(F.col("html")).alias("title"), best_text(F.col("html"), least_words).alias("text")), "page-texts")  # read twice below
    kept = exact_dedup(read.where(X.word_count(F.col("text")) >= least_words))
    url, text = F.col("url"), F.col("text")
    docs = as_documents(kept.withColumns({
        "doc_id": F.md5("url"), "source": F.lit("web"), "domain": X.registered_domain(url), "content_type": X.content_type(url, text), "code_language": X.code_language(url),
        "word_count": X.word_count(text), "char_count": F.length("text"),
    }))
    return apply_weights(docs).withColumn("signal", signal_score(url, text))


def dataset_documents(rows: DataFrame, repo: str, split: str, text_field: str = "text", order: str = "ord", least_words: int = 30, max_docs: int | None = None) -> DataFrame:
    """Rows of a dataset as documents, numbered in order among those kept; at most max_docs (0 or none: all)."""
    from ..tables import running_total

    kept = rows.select(F.col(order).alias("ord"), F.col(text_field).alias("text")).where(X.word_count(F.col("text")) >= least_words)
    if max_docs:
        kept = kept.orderBy("ord").limit(max_docs)
    numbered = running_total(kept.withColumn("_one", F.lit(1)), ["ord"], "_one", "n").drop("_one")
    key = F.concat_ws(":", F.lit(repo), F.lit(split), F.col("n").cast("string"))
    url = F.concat(F.lit(f"hf://{repo}/{split}#"), F.col("n").cast("string"))
    return apply_weights(as_documents(numbered.withColumns({"doc_id": F.md5(key), "url": url, "source": F.lit("huggingface"), "domain": F.lit("huggingface.co"), "word_count": X.word_count(F.col("text"))})))


def repository_files(files: DataFrame) -> DataFrame:
    """Blobs (path, size, type, text, stars, ord) of repositories as documents: by suffix and size, code from 10 words on."""
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    typed = files.where(F.col("type") == "blob").where(F.col("size") <= V.REPO_MAX_BYTES)
    typed = typed.withColumn("content_type", F.when(suffix.isin(*V.REPO_CODE_SUFFIXES), "source_code").when(suffix.isin(*V.REPO_DOC_SUFFIXES), "technical_doc"))
    kept = typed.where("content_type IS NOT NULL").where(X.word_count(F.col("text")) >= 10)
    language = F.coalesce(F.create_map(*(F.lit(x) for kv in V.CODE_SUFFIXES.items() for x in kv))[suffix], F.lit(""))
    docs = as_documents(kept.withColumns({"doc_id": F.md5("path"), "url": F.col("path"), "source": F.lit("github"), "domain": F.lit("github.com"), "code_language": language}))
    weighted = apply_weights(docs)
    return weighted.withColumn("final_weight", star_bonus(F.col("final_weight"), F.col("stars")))


def issue_documents(issues: DataFrame) -> DataFrame:
    """Closed issues (ord, title, body, html_url, pull_request) as documents, pull requests left out."""
    kept = issues.where("pull_request IS NULL").where(X.word_count(F.coalesce("body", F.lit(""))) >= 20)
    text = F.concat(F.lit("Issue: "), F.col("title"), F.lit("\n\n"), F.col("body"))
    return apply_weights(as_documents(kept.withColumns({"text": text, "doc_id": F.md5("html_url"), "url": F.col("html_url"), "source": F.lit("github"), "domain": F.lit("github.com"), "content_type": F.lit("technical_qa")})))


_LISTS = ("authors", "categories")
_ENTRY = T.StructType([T.StructField(n, T.ArrayType(T.StringType()) if n in _LISTS else T.StringType()) for n in ("arxiv_id", "url", "title", "abstract", "authors", "categories", "published", "updated", "doi")])


@F.pandas_udf(T.ArrayType(_ENTRY))
def _entries(feeds: pd.Series) -> pd.Series:
    """The entries of each feed, element by element; XPath expressions of columns can't stay inside one entry. A feed that isn't XML has none."""
    import xml.etree.ElementTree as tree

    local = lambda e: e.tag.rsplit("}", 1)[-1]
    squeezed = lambda t: " ".join((t or "").split())

    def of(xml: str | None) -> list[dict]:
        try:
            root = tree.fromstring(xml or "")
        except tree.ParseError:
            return []
        out = []
        for entry in (e for e in root.iter() if local(e) == "entry"):
            first: dict[str, str] = {}
            for e in entry:
                first.setdefault(local(e), e.text or "")
            url = squeezed(first.get("id"))
            out.append({
                "arxiv_id": re.sub(r"v\d+$", "", url.rsplit("/abs/", 1)[-1]), "url": url, "title": squeezed(first.get("title")), "abstract": squeezed(first.get("summary")),
                "authors": [squeezed(n.text) for a in entry if local(a) == "author" for n in a if local(n) == "name"],
                "categories": [c.get("term") for c in entry if local(c) == "category" and c.get("term")],
                "published": squeezed(first.get("published")), "updated": squeezed(first.get("updated")), "doi": squeezed(first.get("doi")),
            })
        return out

    return feeds.map(of)


def atom_entries(feeds: DataFrame) -> DataFrame:
    """Entries of Atom feeds (xml): arxiv_id without its version, url, title, abstract, authors, categories, published, updated, doi; what an entry lacks is empty."""
    return feeds.select(F.explode(_entries(F.col("xml"))).alias("e")).select("e.*")


def paper_documents(papers: DataFrame, citations: DataFrame | None = None) -> DataFrame:
    """Papers (ord, arxiv_id, title, abstract, authors, categories, published, doi) as documents, with citations joined on arxiv_id."""
    papers = papers.where(X.word_count(F.coalesce("abstract", F.lit(""))) >= 20)
    if citations is not None:
        papers = papers.join(citations.select("arxiv_id", F.col("citations").alias("_c")), "arxiv_id", "left").withColumn("citations", F.coalesce("_c", F.lit(0))).drop("_c")
    elif "citations" not in papers.columns:
        papers = papers.withColumn("citations", F.lit(0))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Title: "), "title"), F.concat(F.lit("Authors: "), F.concat_ws(", ", F.slice("authors", 1, 6))), F.concat(F.lit("Categories: "), F.concat_ws(", ", "categories")),
        F.concat(F.lit("Published: "), F.substring("published", 1, 10)), F.when(F.col("doi") != "", F.concat(F.lit("DOI: "), "doi")),
        F.when(F.col("citations") > 0, F.concat(F.lit("Citations: "), F.col("citations").cast("string"))), F.concat(F.lit("\nAbstract:\n"), "abstract"),
    )
    url = F.concat(F.lit("https://arxiv.org/abs/"), "arxiv_id")
    docs = apply_weights(as_documents(papers.withColumns({"text": text, "doc_id": F.md5(url), "url": url, "source": F.lit("arxiv"), "domain": F.lit("arxiv.org"), "content_type": F.lit("research_paper")})))
    return docs.withColumn("final_weight", citation_bonus(F.col("final_weight"), F.col("citations")))


def repair_hyphens(text):
    """Words joined that a line break cut, and at most one empty line in a row."""
    return F.regexp_replace(F.regexp_replace(text, r"(\w)-\n(\w)", "$1$2"), r"\n{3,}", "\n\n")


def _locs(xml, parent: str):
    """The loc elements of a sitemap (urlset: pages) or of an index of sitemaps (sitemapindex)."""
    return F.transform(F.xpath(xml, F.lit(f"/*[local-name()='{parent}']/*/*[local-name()='loc']/text()")), lambda u: F.regexp_replace(u, r"^\s+|\s+$", ""))


def sitemap_urls(maps: DataFrame, fetched: DataFrame | None = None, depth: int | None = None) -> DataFrame:
    """(base, url) of the pages that sitemaps (base, xml) name; one sitemap for each base.

    An index names other sitemaps: those in fetched (url, xml) are followed to the end, each once for a base, so indexes may name one another; at most `depth` times, if given. Pages keep
    the base they were reached from.
    """
    maps = maps.dropDuplicates(["base"])
    pages = [maps.select("base", F.explode(_locs(F.col("xml"), "urlset")).alias("url"))]
    inner = maps.select("base", F.explode(_locs(F.col("xml"), "sitemapindex")).alias("url")).distinct()
    seen, level = None, 0
    while fetched is not None and (depth is None or level < depth):
        new = written(inner if seen is None else inner.join(seen, ["base", "url"], "left_anti"), "sitemaps")
        if new.isEmpty():
            break
        seen = new if seen is None else seen.unionByName(new)
        read = new.join(fetched.select("url", F.col("xml").alias("_xml")), "url")
        pages.append(read.select("base", F.explode(_locs(F.col("_xml"), "urlset")).alias("url")))
        inner = read.select("base", F.explode(_locs(F.col("_xml"), "sitemapindex")).alias("url")).distinct()
        level += 1
    return reduce(DataFrame.unionByName, pages).distinct() if len(pages) > 1 else pages[0]


def starred(repositories: DataFrame, least: int = 0, least_words: int = 20) -> DataFrame:
    """Repositories (stars, readme) with enough stars; readme is null where it has fewer words than it must."""
    return repositories.where(F.coalesce("stars", F.lit(0)) >= least).withColumn("readme", F.when(X.word_count(F.coalesce("readme", F.lit(""))) >= least_words, F.col("readme")))


def base64_bodies(files: DataFrame, content: str = "content", encoding: str = "encoding"):
    """Files whose bodies came as base64, as text; other encodings as they are, and nothing where the body can't be decoded."""
    plain = F.expr(f"try_to_binary(regexp_replace({content}, '\\\\s', ''), 'base64')")
    return files.withColumn("text", F.when(F.col(encoding) == "base64", F.decode(plain, "UTF-8")).otherwise(F.col(content)))


def union_sources(sources: dict[str, DataFrame], overwrite: bool = True) -> DataFrame:
    """Documents of several sources, in their fixed order of precedence; without overwrite a row's own source stands, as when group files are put together."""
    order = ("web", "github", "arxiv", "huggingface", "google")
    out = None
    for name in sorted(sources, key=lambda s: order.index(s) if s in order else len(order)):
        rows = sources[name]
        own = F.col("source") if "source" in rows.columns and not overwrite else F.lit(None)
        rows = rows.withColumn("source", F.coalesce(own, F.lit(name)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def tag_group(docs: DataFrame, group: str) -> DataFrame:
    given = F.coalesce("meta", F.create_map().cast("map<string,string>"))
    return docs.withColumn("meta", F.map_concat(F.map_filter(given, lambda k, _: k != "dataset_group"), F.create_map(F.lit("dataset_group"), F.lit(group))))


def log_lines(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """(file, at, line) of text logs without their empty lines; at orders a file's lines. The last lines of each file, if asked.

    Lines are read as rows, so a log of any size is cut into splits; ids of rows rise within a split, and splits in the order of their blocks.
    """
    from pyspark.sql import Window

    read = spark.read.text(path).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), F.col("value").alias("line"))
    lines = read.where("line <> ''").select("file", F.struct("_block", "_row").alias("at"), "line")
    if last is None:
        return lines
    return lines.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy(F.desc("at")))).where(F.col("_n") <= last).drop("_n")


def file_tree(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256, modified) of all files below path; hashes as sinks.hashed has them."""
    from .sinks import hashed

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return files.select("path", F.col("modificationTime").alias("modified")).join(hashed(files), "path").select("path", "size", "sha256", "modified")


def binary_shards(spark: SparkSession, path: str, bits: int = 16) -> DataFrame:
    """(file, tokens) of binary shards."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"file": pdf["path"].str.rsplit("/", n=1).str[-1], "tokens": [np.frombuffer(c, f"<u{bits // 8}").astype(np.int32) for c in pdf["content"]]})

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path).select("path", "content").mapInPandas(read, "file string, tokens array<int>")
