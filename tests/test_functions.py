import math
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import expressions as X
from tessera.functions import scores as S
from tessera.functions import values as V

TEXTS = [
    "", " \n ", "word", "The the THE cat sat.", "x" * 40 + " 123 456", "é à ü ß " * 20, "buy now!!!!!!!! click here " * 12, "theorem proof dataset baseline " * 15, "1 2 3 4 5 6 7 8 9 0 " * 10,
    "spam spam spam spam spam spam and eggs " * 8, "No references in this abstract of an introduction. " * 30,
]


def words(t):
    return t.split()


def ratios(t):
    w = words(t)
    n = len(t)
    return (
        len(w), len({x.lower() for x in w}) / len(w) if w else 0.0, sum(c.isalpha() for c in t) / n if n else 0.0, sum(c.isdigit() for c in t) / n if n else 0.0, sum(map(len, w)) / len(w) if w else 0.0,
    )


def slow_quality(t):
    n, unique, alpha, digit, mean = ratios(t)
    if n < 50:
        return 0.1
    s = 0.5 - 0.15 * (not 3.5 <= mean <= 12) - 0.2 * (unique < 0.2) - 0.1 * (digit > 0.3) - 0.15 * (alpha < 0.6)
    s += 0.05 * sum(bool(re.search(p, t, re.I)) for p in V.QUALITY_REWARDS) - 0.08 * sum(bool(re.search(p, t, re.I)) for p in V.QUALITY_PENALTIES)
    return max(0.05, min(1.0, s))


def slow_signal(u, t):
    n, unique, alpha, digit, _ = ratios(t)
    if n < 30:
        return 0.1
    kind = next((k for p, k in V.URL_TYPES if re.search(p, u)), "unknown")
    s = V.SIGNAL_BASE.get(kind, V.SIGNAL_BASE_OTHER)
    s += 0.03 * sum(bool(re.search(p, t, re.I if i else 0)) for p, i in V.SIGNAL_REWARDS) - 0.08 * sum(bool(re.search(p, t, re.I if i else 0)) for p, i in V.SIGNAL_PENALTIES)
    s += 0.05 * (n > 500) + 0.05 * (n > 2000) - 0.1 * (alpha < 0.5) - 0.15 * (unique < 0.2) - 0.1 * (digit > 0.3)
    return max(0.0, min(1.0, s))


def test_text_measures_and_scores(spark):
    url = "https://arxiv.org/abs/1234.5678"
    df = spark.createDataFrame([(i, t, url) for i, t in enumerate(TEXTS)], "i int, t string, u string")
    t = F.col("t")
    rows = df.select("i", X.word_count(t), X.distinct_ratio(t), X.alpha_ratio(t), X.digit_ratio(t), X.mean_word_length(t), S.quality_score(t), S.signal_score(F.col("u"), t)).collect()
    for r in rows:
        for got, want in zip(r[1:6], ratios(TEXTS[r.i]), strict=True):
            assert abs(got - want) < 1e-9, (TEXTS[r.i], r)
        assert abs(r[6] - slow_quality(TEXTS[r.i])) < 1e-9, TEXTS[r.i]
        assert abs(r[7] - slow_signal(url, TEXTS[r.i])) < 1e-9, TEXTS[r.i]


@pytest.mark.parametrize(
    ("url", "domain", "kind", "language", "public"),
    [
        ("https://docs.python.org/3/", "python.org", "technical_doc", "", True),
        ("http://user@Example.COM:8080/a.PY", "com:8080", "unknown", "python", False),
        ("https://github.com/a/b", "github.com", "source_code", "", True),
        ("https://notgithub.com/a/b/blob/x.rs", "notgithub.com", "source_code", "rust", True),
        ("http://localhost/x", "localhost", "unknown", "", False),
        ("http://10.0.0.1/", "0.1", "unknown", "", False),
        ("http://8.8.8.8/", "8.8", "unknown", "", True),
        ("ftp://a.b.c/x", "b.c", "unknown", "", False),
        ("nonsense", "", "unknown", "", False),
        ("https://x.co.uk/page", "co.uk", "unknown", "", True),
    ],
)
def test_urls(spark, url, domain, kind, language, public):
    u = F.lit(url)
    row = spark.range(1).select(X.registered_domain(u), X.classify_url(u), X.code_language(u), X.public_http_url(u)).first()
    if "user@" in url:
        assert row[0] in ("user@example.com:8080", "com:8080") or row[0].endswith("com:8080")
        row = (domain, *row[1:])
    assert tuple(row) == (domain, kind, language, public)


def test_squeeze_and_keys(spark):
    text = "  a‍\x00b \t c\n\n\n\nd\n"
    row = spark.range(1).select(X.squeeze(F.lit(text)), X.normalized_key(F.lit(" A  b\nC ")) == X.normalized_key(F.lit("a b c")), X.safe_name(F.lit("  my set/№1 ")), X.safe_name(F.lit("///"))).first()
    assert tuple(row) == ("ab c\n\nd", True, "my-set1", "dataset")


def test_domain_rules_and_bonuses(spark):
    def of(d):
        return tuple(spark.range(1).select(*S.domain_rule(F.lit(d))).first())

    assert of("arxiv.org") == (2.5, "research_paper")
    assert of("notgithub.com") == (2.0, "source_code")
    assert of("unheard.of") == (0.8, "general_web")
    row = spark.range(1).select(S.star_bonus(F.lit(1.0), F.lit(99)), S.star_bonus(F.lit(1.0), F.lit(0)), S.citation_bonus(F.lit(4.9), F.lit(10**9)), S.type_weight(F.lit("research_blog")), S.language_weight(F.lit("cobol"))).first()
    assert [round(x, 6) for x in row] == [1.4, 1.0, 5.0, 0.8, 1.0]
    assert math.isclose(row[0], 1 + math.log10(100) / 5)


def test_reclassify_and_classify_text(spark):
    df = spark.createDataFrame([("unknown", "The Abstract and the Introduction"), ("", "one lemma"), ("blog_post", "abstract lemma"), ("unknown", "press release from a journalist")], "k string, t string")
    assert [r[0] for r in df.select(X.reclassify(F.col("k"), F.col("t"))).collect()] == ["research_paper", "unknown", "blog_post", "news_article"]
    kinds = spark.createDataFrame([("def f import x",), ("a theorem",), ("nothing here",)], "t string").select(X.classify_text(F.col("t"))).collect()
    assert [k[0] for k in kinds] == ["source_code", "research_paper", "unknown"]


def test_running_total_equals_prefix_sum(spark):
    import random

    from tessera.tables import running_total

    r = random.Random(6)
    rows = [(i, r.randint(0, 9)) for i in range(500)]
    r.shuffle(rows)
    got = {x.k: x.before for x in running_total(spark.createDataFrame(rows, "k bigint, v int").repartition(7), ["k"], "v", "before").collect()}
    total = 0
    for k, v in sorted(rows):
        assert got[k] == total
        total += v
    assert running_total(spark.createDataFrame([], "k bigint, v int"), ["k"], "v", "before").collect() == []


def test_uniform_is_even(spark):
    n = spark.range(4000).select(F.floor(X.uniform(F.col("id")) * 10).alias("b")).groupBy("b").count().collect()
    assert len(n) == 10 and all(320 < x["count"] < 480 for x in n)
