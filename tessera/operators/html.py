"""Titles, links and text of pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as X

#: Elements whose content isn't text of the page.
DROPPED = ("script", "style", "nav", "footer", "header", "aside", "form", "noscript", "iframe", "svg", "button")


def page_title(html: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), r"^\s+|\s+$", "")


def page_text(html: Column) -> Column:
    """Text by pattern: dropped elements out, tags to spaces, white space collapsed."""
    body = html
    for tag in DROPPED:
        body = F.regexp_replace(body, rf"(?is)<{tag}(\s[^>]*)?>.*?</{tag}>", " ")
    return F.regexp_replace(F.regexp_replace(X.strip_tags(body), r"\s+", " "), r"^ | $", "")


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


_HREFS = r"(?i)<a\s[^>]*href=[\"']([^\"'#]*)"


def _resolved(url: Column, href: Column) -> Column:
    """An href as a URL; those without a scheme are taken from the page's origin."""
    out = F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), href))
    return out.when(href.startswith("/"), F.concat(origin(url), href)).otherwise(F.concat(origin(url), F.lit("/"), href))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, url, link): http links of each page; those without a scheme are taken from the page's origin."""
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(_HREFS), F.lit(1))
    each = pages.select("page_id", "url", F.explode(F.array_distinct(hrefs)).alias("href"))
    return each.select("page_id", "url", _resolved(F.col("url"), F.col("href")).alias("link")).where(F.col("link").startswith("http")).distinct()


def links_in_order(pages: DataFrame) -> DataFrame:
    """(ord, place, link) of pages (url, ord, html): http links with their place among the page's, repeated ones too."""
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(_HREFS), F.lit(1))
    each = pages.select("url", "ord", F.posexplode(hrefs).alias("place", "href"))
    return each.select("ord", "place", _resolved(F.col("url"), F.col("href")).alias("link")).where(F.col("link").startswith("http"))


_EXTRACTED = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("links", T.ArrayType(T.StringType()))])


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.parts, self.links, self._out, self._in_title = "", [], [], 0, False

    def handle_starttag(self, tag, attrs):
        if tag in DROPPED:
            self._out += 1
        elif tag == "title":
            self._in_title = True
        elif tag == "a" and (href := dict(attrs).get("href")):
            self.links.append(href)

    def handle_endtag(self, tag):
        if tag in DROPPED and self._out:
            self._out -= 1
        elif tag == "title":
            self._in_title = False

    def handle_data(self, data):
        if self._in_title:
            self.title += data
        elif not self._out and data.strip():
            self.parts.append(data.strip())


def best_text(html: Column, least_words: int = 30) -> Column:
    """The parser's text if it has enough words, else the text by pattern."""
    parsed = extract(html)["text"]
    return F.when(X.word_count(parsed) >= least_words, parsed).otherwise(page_text(html))


@F.pandas_udf(_EXTRACTED)
def extract(html: pd.Series) -> pd.DataFrame:
    """Title, text and raw links by a real parser; pages that no pattern fits need one."""
    rows = []
    for h in html:
        p = _Text()
        p.feed(h or "")
        p.close()
        rows.append((p.title.strip(), "\n".join(p.parts), p.links))
    return pd.DataFrame(rows, columns=["title", "text", "links"])
