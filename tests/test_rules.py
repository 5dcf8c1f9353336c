import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import scores as S
from tessera.operators import rules as R
from tessera.sources import readers, sinks
from tessera.streaming import stateful
from tessera.tables import new_path


def brute(domains, table):
    out = {}
    for d in domains:
        out[d] = next(((w, c) for _, p, w, c in sorted(table, key=lambda r: r[0]) if p is not None and (p == "*" or fnmatch.fnmatchcase(d, p) or p in d)), (0.8, "general_web"))
    return out


def rule_rows(seed, n):
    r = random.Random(seed)
    letters = "abc.-"
    word = lambda k: "".join(r.choice(letters) for _ in range(k))
    shapes = [lambda: word(r.randint(1, 6)), lambda: "*." + word(3), lambda: word(2) + "*" + word(2), lambda: "?" * r.randint(1, 4) + "*" + word(1), lambda: "[a-b]" + word(3) + "*", lambda: "[!a]*" + word(2), lambda: word(2) + "[", lambda: "*" * r.randint(2, 3), lambda: None]
    weights = [40, 20, 15, 5, 10, 5, 2, 1, 2]
    return [(i, r.choices(shapes, weights)[0](), r.randint(1, 30) / 10, f"c{i % 9}") for i in range(n)], [word(r.randint(1, 12)) for _ in range(120)]


@pytest.mark.parametrize("seed", range(3))
def test_table_equals_trying_all(spark, seed):
    table, domains = rule_rows(seed, 150)
    table = [x for x in table if x[1] is None or set(x[1]) != {"*"} or x[0] > 100]
    got = {x.domain: (x.weight, x.category) for x in R.domain_weights(spark.createDataFrame([(d,) for d in domains], "domain string"), spark.createDataFrame(table, "ord int, pattern string, weight double, category string")).collect()}
    assert got == brute(set(domains), table)


def test_ten_thousand_rules(spark):
    """Rules that no domain can fit are out before anything is tried; the first of those that fit wins."""
    r = random.Random(4)
    hosts = [f"h{r.randrange(3000)}.s{r.randrange(40)}.org" for _ in range(500)]
    table = [(i, f"h{i}.s" if i % 2 else f"*{i}.s?.org", 1 + i / 10, f"c{i}") for i in range(10_000)]
    docs = spark.createDataFrame([(i, h, "old") for i, h in enumerate(hosts)] + [(900, None, "old")], "doc_id int, domain string, category string")
    got = R.apply_rules(docs, spark.createDataFrame(table, "ord int, pattern string, weight double, category string")).collect()
    want = brute(set(hosts), table) | {None: (0.8, "general_web")}
    assert len(got) == 501 and all((x.domain_weight, x.category) == want[x.domain] for x in got)


def test_pieces_are_in_every_domain_that_fits():
    r = random.Random(6)
    for seed in range(20):
        table, domains = rule_rows(seed + 50, 60)
        for _, p, _, _ in table:
            for d in domains:
                if p is not None and (fnmatch.fnmatchcase(d, p) or p in d):
                    assert all(x in d for x in R.pieces(p)), (p, d)
    assert r


@pytest.mark.parametrize("pattern", ["*.edu", "a?c.org", "*", "[ab]x.org", "plain", "x[!y].net", "b[", "*.e[!a-c]u"])
def test_rule_fits(spark, pattern):
    domains = ["mit.edu", "edu", "abc.org", "ax.org", "cx.org", "plain.org", "xz.net", "xy.net", "b[", "a.edu\n", "mit.eau"]
    got = {x.d: x.fits for x in spark.createDataFrame([(d,) for d in domains], "d string").select("d", S.rule_fits(F.col("d"), pattern).alias("fits")).collect()}
    assert got == {d: pattern == "*" or fnmatch.fnmatchcase(d, pattern) or pattern in d for d in domains}


def test_no_rules_and_no_domains(spark):
    none = spark.createDataFrame([], "ord int, pattern string, weight double, category string")
    assert [tuple(x) for x in R.domain_weights(spark.createDataFrame([("a.org",), (None,)], "domain string"), none).collect()] == [("a.org", 0.8, "general_web")]
    assert R.domain_weights(spark.createDataFrame([], "domain string"), none).collect() == []


@pytest.mark.parametrize("ids", [[70_000], [3, -1], [65_536]])
def test_ids_that_shards_cannot_hold(spark, ids):
    packed = spark.createDataFrame([(0, 0, [1, 2]), (1, 0, ids)], "shard int, at int, tokens array<int>")
    with pytest.raises(Exception, match="don't fit into 16 bits"):
        sinks.write_shards(packed, new_path(spark, "shards"), "train")
    assert sinks.write_shards(spark.createDataFrame([(0, 0, [65_535])], "shard int, at int, tokens array<int>"), new_path(spark, "shards"), "train").collect()[0].n_tokens == 1


def test_nested_sitemaps_to_the_end(spark):
    """Indexes four deep, one of which names the first again."""
    index = lambda *urls: "<sitemapindex>" + "".join(f"<sitemap><loc>{u}</loc></sitemap>" for u in urls) + "</sitemapindex>"
    pages = lambda *urls: "<urlset>" + "".join(f"<url><loc> {u} </loc></url>" for u in urls) + "</urlset>"
    maps = spark.createDataFrame([("a", index("1", "p0")), ("b", pages("x"))], "base string, xml string")
    fetched = spark.createDataFrame([("1", index("2", "p1")), ("2", index("3", "1")), ("3", index("p3")), ("p0", pages("u0")), ("p1", pages("u1", "u0")), ("p3", pages("u3"))], "url string, xml string")
    got = lambda **more: sorted(map(tuple, readers.sitemap_urls(maps, fetched, **more).collect()))
    assert got() == [("a", "u0"), ("a", "u1"), ("a", "u3"), ("b", "x")]
    assert got(depth=1) == [("a", "u0"), ("b", "x")] and got(depth=2) == [("a", "u0"), ("a", "u1"), ("b", "x")]


def seen(spark, rows, late):
    """What a stream of ten files gives, a file a batch."""
    source, out = new_path(spark, "in"), new_path(spark, "out")
    df = spark.createDataFrame(rows, "n int, t string, text string").selectExpr("n", "t::timestamp_ntz AS ts", "text")
    df.repartitionByRange(10, "n").write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    stateful.first_seen(stream, late=late).writeStream.option("checkpointLocation", new_path(spark, "state")).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    return spark.read.schema(df.schema).parquet(out).collect()


def test_first_seen_over_many_batches(spark):
    rows = [(i, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", f"t{i % 17}") for i in range(400)]
    assert sorted(x.text for x in seen(spark, rows, None)) == sorted({t for _, _, t in rows})


def test_first_seen_within_a_watermark(spark):
    """Each text is given, and never again within the bound of a row that was."""
    rows = [(i, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", f"t{i % 17}") for i in range(400)]
    got = seen(spark, rows, "30 minutes")
    assert {x.text for x in got} == {t for _, _, t in rows} and 17 <= len(got) < 400
    times = {}
    for x in sorted(got, key=lambda x: x.ts):
        assert x.text not in times or (x.ts - times[x.text]).total_seconds() > 30 * 60
        times[x.text] = x.ts
