import pytest
from pyspark.sql import functions as F

from tessera.plans import crawling, loop_queries
from tessera.tables import new_path, written


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def crawled(spark):
    """A small web: a site of a chain, a loop and repeated texts, another of poor pages."""
    text = lambda k: " ".join(f"word{k}x{i}" for i in range(40))
    page = lambda k, links: f"<html><title>t{k}</title><p>{text(k)}</p><nav>" + "".join(f"<a href='{x}'>l</a>" for x in links) + "</nav>"
    web = {f"http://good.org/{k}": page(k, [f"/{k + 1}", "/0", "http://bad.net/0"]) for k in range(6)}
    web |= {f"http://bad.net/{k}": page(100 + k, [f"/{k + 1}", f"/{k + 2}", f"/{k + 3}"]) for k in range(9)}
    web |= {"http://good.org/2": page(1, ["/3"]), "http://good.org/9": "<p>short</p>"}
    return web


def fetch_of(spark, web):
    table = written(spark.createDataFrame([(u, 200, "text/html", h) for u, h in web.items()], "url string, status int, content_type string, html string"), "web")
    return lambda requests: table.join(requests, "url", "left_semi")


def config(**more):
    score = lambda url, text: F.when(url.contains("bad"), 0.1).otherwise(0.9)
    return crawling.CrawlConfig(**({"max_depth": 3, "gate_least": 2, "gate_window": 4, "gate_threshold": 0.3, "score": score} | more))


def brute(web, seeds, c, score):
    """The levels in plain Python."""
    import re

    visited, keys, front, n, scores, shut, order = {}, set(), list(seeds), {}, {}, set(), 0
    for depth in range(c.max_depth + 1):
        read, fates = [], {}
        gone = {d for d in shut}, dict(n)
        for u in front:
            d = ".".join(u.split("/")[2].split(".")[-2:])
            if d in gone[0]:
                fates[u] = "abandoned"
            elif gone[1].get(d, 0) >= c.pages_per_domain:
                fates[u] = "capped"
            elif u not in web:
                fates[u] = "failed"
            else:
                text = " ".join(re.sub("<[^>]+>", " ", re.sub("<title>.*?</title>|<nav>.*?</nav>", "", web[u])).split())
                read.append((u, d, text))
        seen, kept = set(), []
        bad = set()
        for u, d, text in read:
            if len(text.split()) < 30:
                fates[u] = "short"
            elif text in keys or text in seen:
                fates[u] = "repeated"
            elif d in bad:
                fates[u] = "abandoned"
            elif n.get(d, 0) >= c.pages_per_domain:
                fates[u] = "capped"
            else:
                fates[u] = "kept"
                kept.append(u)
                n[d] = n.get(d, 0) + 1
                last = scores.setdefault(d, [])
                last.append(score(u))
                window = last[-c.gate_window :]
                if len(last) >= c.gate_least and sum(window) / len(window) < c.gate_threshold:
                    bad.add(d)
            if len(text.split()) >= 30:
                seen.add(text)
        keys |= seen
        shut |= bad
        visited |= {u: (depth, f) for u, f in fates.items()}
        links = [x if x.startswith("http") else "/".join(u.split("/")[:3]) + x for u in kept for x in re.findall("href='([^']*)'", web[u])]
        front = [x for x in dict.fromkeys(links) if x not in visited]
        if not front:
            break
    return sorted((u, d, f) for u, (d, f) in visited.items())


@pytest.mark.parametrize("more", [{"pages_per_domain": 3}, {"max_depth": 5, "gate_least": 3}])
def test_crawl_equals_brute_force(spark, crawled, more):
    c = config(**more)
    seeds = ["http://good.org/0", "http://bad.net/0", "http://good.org/9", "http://gone.org/"]
    crawl = crawling.Crawl(spark, new_path(spark, "crawl"), fetch_of(spark, crawled), c)
    pages = crawl.run(spark.createDataFrame([(u, i) for i, u in enumerate(seeds)] + [(seeds[0], 9)], "url string, ord bigint"))
    got = rows(crawl.visited().select("url", "depth", "outcome"))
    assert got == brute(crawled, seeds, c, lambda u: 0.1 if "bad" in u else 0.9)
    assert sorted(r.url for r in pages.collect()) == sorted(u for u, _, f in got if f == "kept")


def test_a_crawl_goes_on_after_a_lost_level(spark, crawled):
    """Killed in its third level, after some of that level's tables were written."""
    c, seeds = config(), spark.createDataFrame([("http://good.org/0", 0), ("http://bad.net/0", 1)], "url string, ord bigint")
    whole = crawling.Crawl(spark, new_path(spark, "crawl"), fetch_of(spark, crawled), c)
    whole.run(seeds)
    folder, asked = new_path(spark, "crawl"), []
    fetch = fetch_of(spark, crawled)

    def failing(requests):
        asked.append(requests.count())
        if len(asked) == 3:
            raise RuntimeError("lost")
        return fetch(requests)

    broken = crawling.Crawl(spark, folder, failing, c)
    with pytest.raises(RuntimeError, match="lost"):
        broken.run(seeds)
    assert len(broken.levels) == 3  # the seeds and two whole levels
    broken._write(spark.createDataFrame([("http://torn.org/", 0)], "url string, ord bigint"), 3, "kept")
    again = crawling.Crawl(spark, folder, fetch, c)
    assert len(again.levels) == 3
    again.run(seeds)
    assert rows(again.visited()) == rows(whole.visited()) and rows(again.pages()) == rows(whole.pages())


def test_sitemaps_robots_and_language(spark, crawled):
    c = config(language=lambda text: F.when(text.contains("word1x"), "fr"))
    robots = spark.createDataFrame([("good.org", "*", False, "/3")], "host string, agent string, allow boolean, prefix string")
    crawl = crawling.Crawl(spark, new_path(spark, "crawl"), fetch_of(spark, crawled), c, robots)
    crawl.run(spark.createDataFrame([("http://good.org/0", 0)], "url string, ord bigint"), spark.createDataFrame([("http://good.org/5", 0), ("http://good.org/0", 1)], "url string, ord bigint"))
    got = {r.url: (r.depth, r.outcome) for r in crawl.visited().collect()}
    assert got["http://good.org/5"] == (1, "kept") and got["http://good.org/1"] == (1, "failed")
    assert "http://good.org/3" not in got or got["http://good.org/3"][1] == "blocked"


def test_live_fetches(spark):
    pages = {"http://a.org/": (200, "text/html", "x"), "http://b.org/": (404, "text/html", "")}
    got = crawling.fetched(spark.createDataFrame([(u,) for u in (*pages, "http://none.org/")], "url string"), pages.get, 3)
    assert rows(got) == sorted((u, *p) for u, p in pages.items())


def test_no_seeds(spark, crawled):
    crawl = crawling.Crawl(spark, new_path(spark, "crawl"), fetch_of(spark, crawled), config())
    assert crawl.run(spark.createDataFrame([], "url string, ord bigint")).collect() == []


def test_the_gate_needs_its_window():
    with pytest.raises(ValueError, match="window"):
        crawling.Crawl(None, "x", None, crawling.CrawlConfig(gate_window=3, gate_least=10))


def test_web_answers_every_url(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    first = pages.orderBy("page_id").first()
    got = {r.url: r.html for r in loop_queries.web(pages)(spark.createDataFrame([(first.url,), ("http://nowhere.org/x",)], "url string")).collect()}
    assert got[first.url] == first.html and got["http://nowhere.org/x"]
