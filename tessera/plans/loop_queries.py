"""Registered queries of the loops: the crawl, and what it is made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import values as V
from ..functions import expressions as X
from ..operators import html, language, schedule
from ..tables import new_path, written
from . import crawling, store
from .queries import DOMAIN, NETLOC, PARSED, SIGNAL_PENALTIES, documents, pages, query, sql_n_words, sql_signal, sql_text


@query(f"WITH {PARSED} SELECT page_id, enough, sha256(text) AS key FROM texts")
def best_texts(spark, sf_dir):
    """The parser's text of each page where it has 30 words, else the pattern's."""
    h = F.col("html")
    return pages(spark, sf_dir).select("page_id", html.extract(h)["text"].alias("own"), html.best_text(h).alias("text")).select("page_id", (html.X.word_count(F.col("own")) >= 30).alias("enough"), F.sha2("text", 256).alias("key"))


# --- the crawl

CRAWL = crawling.CrawlConfig(max_depth=3, pages_per_domain=30, gate_threshold=0.405, score=lambda u, t: S.signal_score(u, t, penalties=SIGNAL_PENALTIES))


def web(crawled: DataFrame):
    """A fetch function over a table of pages: a URL is answered with its own page, and any other with the page that its md5 picks, so the table is a web in which every link leads somewhere."""
    kept = written(crawled.select("page_id", "url", "html"), "web")
    n = max(1, kept.count())
    own = kept.groupBy("url").agg(F.min("page_id").alias("own"))

    def fetch(requests: DataFrame) -> DataFrame:
        picked = F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("long") % n
        asked = requests.join(own, "url", "left").select("url", F.coalesce("own", picked).alias("page_id"))
        return asked.join(kept.select("page_id", "html"), "page_id").select("url", F.lit(200).alias("status"), F.lit("text/html").alias("content_type"), "html")

    return fetch


def sql_crawl(c: crawling.CrawlConfig) -> str:
    """The levels of a crawl over pages as the web, one after the other."""
    block = sql_text("|".join(V.URL_BLOCK))
    out = [
        "WITH " + PARSED,
        "own AS (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)",
        "front0 AS MATERIALIZED (SELECT url, row_number() OVER (ORDER BY place_at) - 1 AS ord FROM (SELECT url, min(page_id) AS place_at FROM pages WHERE page_id < 5 GROUP BY url))",
        "state0 AS (SELECT NULL::VARCHAR AS domain, 0 AS n, false AS shut WHERE false)",
        "kept0 AS (SELECT NULL::VARCHAR AS url, NULL::VARCHAR AS domain, 0::BIGINT AS ord, 0::DOUBLE AS score, NULL::VARCHAR AS html, false AS bad WHERE false)",
        "keys0 AS (SELECT NULL::VARCHAR AS key WHERE false)",
    ]
    for d in range(c.max_depth + 1):
        k = d + 1
        seen = " UNION ALL ".join(f"SELECT url FROM front{i}" for i in range(d + 1))
        out += [
            f"asked{d} AS MATERIALIZED (SELECT f.url, f.ord, f.domain, CASE WHEN f.blocked THEN 'blocked' WHEN coalesce(s.shut, false) THEN 'abandoned' WHEN coalesce(s.n, 0) >= {c.pages_per_domain} THEN 'capped' END AS outcome"
            f" FROM (SELECT url, ord, {DOMAIN} AS domain, NOT (regexp_matches(url, '(?i)^https?://') AND {NETLOC} <> '' AND NOT contains({NETLOC}, '@')) OR regexp_matches(url, {block}) AS blocked FROM front{d}) f LEFT JOIN state{d} s USING (domain))",
            f"read{d} AS MATERIALIZED (SELECT a.url, a.domain, a.ord, t.html, t.text, sha256(t.text) AS key, {sql_n_words('t.text')} >= {c.least_words} AS is_long FROM asked{d} a LEFT JOIN own o ON o.url = a.url"
            f" JOIN texts t ON t.page_id = coalesce(o.page_id, CAST('0x' || substr(md5(a.url), 1, 8) AS BIGINT) % (SELECT count(*) FROM pages)) WHERE a.outcome IS NULL)",
            f"first{d} AS MATERIALIZED (SELECT url, domain, ord, html, {sql_signal('url', 'text')} AS score FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ord) AS o FROM read{d} WHERE is_long AND key NOT IN (SELECT key FROM keys{d})) WHERE o = 1)",
            f"rolled{d} AS (SELECT *, row_number() OVER w AS seq, avg(score) OVER (w ROWS BETWEEN {c.gate_window - 1} PRECEDING AND CURRENT ROW) AS rolling FROM (SELECT url, domain, ord, html, score, false AS fresh FROM kept{d} UNION ALL SELECT url, domain, ord, html, score, true FROM first{d}) WINDOW w AS (PARTITION BY domain ORDER BY ord))",
            f"marked{d} AS (SELECT *, seq >= {c.gate_least} AND rolling < {c.gate_threshold} AS bad FROM rolled{d})",
            f"gated{d} AS MATERIALIZED (SELECT *, NOT coalesce(bool_or(bad) OVER (PARTITION BY domain ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS admitted FROM marked{d})",
            f"kept{k} AS MATERIALIZED (SELECT url, domain, ord, score, html, bad FROM kept{d} UNION ALL SELECT url, domain, ord, score, html, bad FROM gated{d} WHERE fresh AND admitted AND seq <= {c.pages_per_domain})",
            f"state{k} AS MATERIALIZED (SELECT domain, count(*) AS n, bool_or(bad) AS shut FROM kept{k} GROUP BY domain)",
            f"keys{k} AS MATERIALIZED (SELECT key FROM keys{d} UNION ALL SELECT key FROM read{d} WHERE is_long)",
            f"visited{d} AS (SELECT a.url, {d} AS depth, coalesce(a.outcome, CASE WHEN r.url IS NULL THEN 'failed' WHEN NOT r.is_long THEN 'short' WHEN g.url IS NULL THEN 'repeated' WHEN NOT g.admitted THEN 'abandoned' WHEN g.seq > {c.pages_per_domain} THEN 'capped' ELSE 'kept' END) AS outcome"
            f" FROM asked{d} a LEFT JOIN read{d} r ON r.url = a.url LEFT JOIN (SELECT * FROM gated{d} WHERE fresh) g ON g.url = a.url)",
            f"hrefs{d} AS (SELECT k.url, k.ord, unnest(range(len(h))) AS place, unnest(h) AS href FROM (SELECT url, ord, regexp_extract_all(html, '(?i)<a\\s[^>]*href=[\"'']([^\"''#]*)', 1) AS h FROM kept{k} WHERE ord IN (SELECT ord FROM front{d})) k)",
            f"links{d} AS (SELECT ord, place, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*:)', 1) || href"
            f" ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || CASE WHEN starts_with(href, '/') THEN '' ELSE '/' END || href END AS link FROM hrefs{d})",
            f"front{k} AS MATERIALIZED (SELECT url, row_number() OVER (ORDER BY place_at) - 1 + (SELECT count(*) FROM ({seen})) AS ord FROM (SELECT link AS url, min(ord * 1000000 + place) AS place_at FROM links{d} WHERE starts_with(link, 'http') GROUP BY link) WHERE url NOT IN ({seen}))",
        ]
    return ", ".join(out) + " " + " UNION ALL ".join(f"SELECT * FROM visited{d}" for d in range(c.max_depth + 1))


def crawl_of(spark: SparkSession, crawled: DataFrame, folder: str, config: crawling.CrawlConfig = CRAWL) -> crawling.Crawl:
    return crawling.Crawl(spark, folder, web(crawled), config)


@query(sql_crawl(CRAWL))
def crawl_visits(spark, sf_dir):
    """Every request of a crawl from the first five pages, with its depth and what became of it."""
    crawled = pages(spark, sf_dir)
    crawl = crawl_of(spark, crawled, new_path(spark, "crawl"))
    crawl.run(crawled.where("page_id < 5").select("url", F.col("page_id").alias("ord")))
    return crawl.visited().select("url", "depth", "outcome")


# --- the fetch schedule

REQUESTS = f"SELECT page_id, {NETLOC} AS host, (page_id * 37) % 5000 AS ready, CASE WHEN page_id % 9 = 0 THEN 5000 WHEN page_id % 11 = 0 THEN 2000 ELSE 1000 END AS wait, row_number() OVER (PARTITION BY {NETLOC} ORDER BY page_id) AS k FROM pages"


@query(f"WITH RECURSIVE r AS MATERIALIZED ({REQUESTS}), s AS (SELECT page_id, host, k, wait, ready::BIGINT AS start FROM r WHERE k = 1 UNION ALL SELECT r.page_id, r.host, r.k, r.wait, greatest(r.ready, s.start + s.wait)::BIGINT FROM s JOIN r ON r.host = s.host AND r.k = s.k + 1) SELECT page_id, host, start FROM s")
def fetch_schedule(spark, sf_dir):
    """When each page may be fetched, if every ninth answers 429 and asks for five seconds, and every eleventh fails once."""
    n = F.col("page_id")
    status = F.when(n % 9 == 0, 429).when(n % 11 != 0, 200)
    wait = schedule.wait_after(status, F.lit(1), F.lit(5))
    asked = pages(spark, sf_dir).select("page_id", X.netloc(F.col("url")).alias("host"), ((n * 37) % 5000).alias("ready"), wait.alias("wait"))
    return schedule.start_times(asked, order="page_id").select("page_id", "host", "start")


# --- stored sessions

@query("SELECT row_number() OVER (ORDER BY n_nationkey) AS dataset_id, 'nation-' || n_nationkey AS group_id, CASE WHEN n_regionkey % 2 = 0 THEN 'complete' ELSE 'pending' END AS crawl, CASE WHEN n_regionkey = 3 THEN 'failed' ELSE 'pending' END AS clean FROM nation")
def session_log(spark, sf_dir):
    """Sessions seeded from the nations, then updated twice, each a version of the stored table."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    log = store.SessionStore(spark, new_path(spark, "sessions"))
    group = F.concat(F.lit("nation-"), F.col("n_nationkey").cast("string"))
    log.seed(nations.select(F.col("n_nationkey").alias("ord"), group.alias("group_id"), F.col("n_name").alias("name")))
    numbered = log.read().select("dataset_id", "group_id").join(nations.select(group.alias("group_id"), "n_regionkey"), "group_id")
    log.refresh(numbered.where("n_regionkey % 2 = 0").select("dataset_id", F.lit("crawl").alias("stage")))
    log.update(numbered.where("n_regionkey = 3").select("dataset_id", F.lit("clean").alias("stage"), F.lit("failed").alias("status")))
    return log.read().select("dataset_id", "group_id", F.col("stages")["crawl"].alias("crawl"), F.col("stages")["clean"].alias("clean"))


# --- language

#: Learnt from documents whose id isn't divisible by four, held against the others.
DETECTED = r"""WITH d AS (SELECT doc_id, lang, doc_id % 4 <> 0 AS taught, regexp_replace(' ' || regexp_replace(lower(coalesce(text, '')), '[\s\d\p{P}\p{S}]+', ' ', 'g') || ' ', ' +', ' ', 'g') AS c FROM documents),
 g AS MATERIALIZED (SELECT doc_id, lang, taught, substr(c, i::INT, 3) AS gram FROM (SELECT *, unnest(range(1, length(c) - 1)) AS i FROM d)),
 n AS MATERIALIZED (SELECT lang, gram, count(*) AS n FROM g WHERE taught AND lang IS NOT NULL GROUP BY 1, 2),
 t AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang),
 kept AS (SELECT DISTINCT gram FROM n),
 m AS MATERIALIZED (SELECT gram, t.lang, ln((coalesce(n.n, 0) + 0.5) / (t.total + 0.5 * ((SELECT count(DISTINCT gram) FROM n) + 1))) AS w FROM kept CROSS JOIN t LEFT JOIN n USING (gram, lang)),
 s AS (SELECT doc_id, m.lang, round(sum(w), 6) AS likely FROM g JOIN m USING (gram) GROUP BY 1, 2),
 b AS (SELECT doc_id, lang AS detected FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY likely DESC, lang) = 1) """


@query(DETECTED + "SELECT d.doc_id, d.lang, b.detected FROM d LEFT JOIN b USING (doc_id)")
def detected_languages(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    model = language.fit(docs.where("doc_id % 4 <> 0"))
    return language.detect(docs, model).join(docs.select("doc_id", "lang"), "doc_id").select("doc_id", "lang", "detected")
