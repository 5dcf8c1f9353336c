"""Registered queries of the library's own operators, each over whole tables, with DuckDB SQL for the same rows where SQL can express them."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import scores as S
from ..functions import values as V
from ..operators import bpe, dedup, frontier, gate, html, reports, rules, shards, weighting
from ..operators.clean import CleanConfig, action_counts, clean, normalize, redact, refusal_hits, refusal_score
from ..sources import crawl, readers, sinks
from ..streaming import stateful
from ..tables import new_path, spread, written
from . import sessions, stages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"))


def rounded(c, n: int = 6):
    return F.round(c, n)


# --- SQL fragments

EDGE = r"([^\p{L}\p{N}_]|$)"
WORDS = r"regexp_extract_all({t}, '\S+')"


def sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def portable(pattern: str) -> str:
    """A pattern with its word boundaries at both ends spelled out, for engines whose own are ASCII."""
    p = pattern
    if p.startswith(r"\b"):
        p = r"(^|[^\p{L}\p{N}_])" + p[2:]
    if p.endswith(r"\b"):
        p = p[:-2] + EDGE
    return p.replace(r"[^\w\s]", r"[^\p{L}\p{N}_\s]")


def sql_any(t: str, pattern: str, ignore_case: bool = True) -> str:
    return f"regexp_matches({t}, {sql_text(portable(pattern))}, '{'i' if ignore_case else 'c'}')"


def sql_sum(parts: list[str]) -> str:
    return " + ".join(parts) if parts else "0"


def sql_case(cases: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in cases) + f" ELSE {default} END"


def sql_n_words(t: str) -> str:
    return f"len({WORDS.format(t=t)})"


def sql_ratio(t: str, cls: str) -> str:
    return f"CASE WHEN length({t}) > 0 THEN length(regexp_replace({t}, '[^{cls}]', '', 'g')) / length({t}) ELSE 0.0 END"


def sql_distinct(t: str) -> str:
    return f"CASE WHEN {sql_n_words(t)} > 0 THEN len(list_distinct({WORDS.format(t=f'lower({t})')})) / {sql_n_words(t)} ELSE 0.0 END"


def sql_mean_word(t: str) -> str:
    return f"CASE WHEN {sql_n_words(t)} > 0 THEN length(regexp_replace({t}, '\\s', '', 'g')) / {sql_n_words(t)} ELSE 0.0 END"


def sql_squeeze(t: str) -> str:
    kept = f"regexp_replace({t}, '[\\x00-\\x08\\x0B-\\x1F\\x7F-\\x{{9F}}\\p{{Cf}}]', '', 'g')"
    lines = f"regexp_replace(regexp_replace({kept}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({lines}, '^\\s+|\\s+$', '', 'g')"


def sql_uniform(*keys: str) -> str:
    joined = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(CAST('0x' || substr(md5({joined}), 1, 8) AS BIGINT) / 4294967296.0)"


def sql_quality(t: str) -> str:
    m = sql_mean_word(t)
    moved = (
        f"0.5 - CASE WHEN {sql_n_words(t)} > 100000 THEN 0.1 ELSE 0 END - CASE WHEN {m} < 3.5 OR {m} > 12 THEN 0.15 ELSE 0 END - CASE WHEN {sql_distinct(t)} < 0.2 THEN 0.2 ELSE 0 END"
        f" - CASE WHEN {sql_ratio(t, chr(92) + 'p{Nd}')} > 0.3 THEN 0.1 ELSE 0 END - CASE WHEN {sql_ratio(t, chr(92) + 'p{L}')} < 0.6 THEN 0.15 ELSE 0 END"
        f" + 0.05 * ({sql_sum([sql_any(t, p) + '::INT' for p in V.QUALITY_REWARDS])}) - 0.08 * ({sql_sum([sql_any(t, p) + '::INT' for p in V.QUALITY_PENALTIES])})"
    )
    return f"CASE WHEN {sql_n_words(t)} < 50 THEN 0.1 ELSE greatest(0.05, least(1.0, {moved})) END"


SIGNAL_PENALTIES = V.SIGNAL_PENALTIES[:-1]  # the last one refers back to a group, which DuckDB has no pattern for


def sql_signal(u: str, t: str) -> str:
    kind = sql_case([(f"regexp_matches({u}, {sql_text(p)})", sql_text(k)) for p, k in V.URL_TYPES], "'unknown'")
    base = sql_case([(f"({kind}) = {sql_text(k)}", str(v)) for k, v in V.SIGNAL_BASE.items()], str(V.SIGNAL_BASE_OTHER))
    moved = (
        f"({base}) + 0.03 * ({sql_sum([sql_any(t, p, i) + '::INT' for p, i in V.SIGNAL_REWARDS])}) - 0.08 * ({sql_sum([sql_any(t, p, i) + '::INT' for p, i in SIGNAL_PENALTIES])})"
        f" + CASE WHEN {sql_n_words(t)} > 500 THEN 0.05 ELSE 0 END + CASE WHEN {sql_n_words(t)} > 2000 THEN 0.05 ELSE 0 END - CASE WHEN {sql_ratio(t, chr(92) + 'p{L}')} < 0.5 THEN 0.1 ELSE 0 END"
        f" - CASE WHEN {sql_distinct(t)} < 0.2 THEN 0.15 ELSE 0 END - CASE WHEN {sql_ratio(t, chr(92) + 'p{Nd}')} > 0.3 THEN 0.1 ELSE 0 END"
    )
    return f"CASE WHEN {sql_n_words(t)} < 30 THEN 0.1 ELSE greatest(0.0, least(1.0, {moved})) END"


NETLOC = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1))"
DOMAIN = f"CASE WHEN len(string_split({NETLOC}, '.')) >= 2 THEN array_to_string(string_split({NETLOC}, '.')[-2:], '.') ELSE {NETLOC} END"
TITLE = "regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '^\\s+|\\s+$', '', 'g')"


def sql_page_text() -> str:
    body = "html"
    for tag in html.DROPPED:
        body = f"regexp_replace({body}, '(?is)<{tag}(\\s[^>]*)?>.*?</{tag}>', ' ', 'g')"
    return f"regexp_replace(regexp_replace(regexp_replace({body}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'), '^ | $', '', 'g')"


def sql_entities(t: str) -> str:
    """The entities that the tables' pages have."""
    for entity, char in (("&quot;?", '"'), ("&copy;?", "©"), ("&middot;?", "·"), ("&amp;?", "&")):
        t = f"regexp_replace({t}, '{entity}', '{char}', 'g')"
    return t


def sql_parsed_text() -> str:
    """What the parser takes for the text of a page: its pieces between tags, trimmed, a line each."""
    body = "html"
    for pattern in (*(rf"<{tag}(\s[^>]*)?>.*?</{tag}>" for tag in html.DROPPED), r"<title[^>]*>.*?</title>", r"<!--.*?-->"):
        body = f"regexp_replace({body}, '(?is){pattern}', chr(1), 'g')"
    plain = sql_entities("x")
    return f"array_to_string(list_filter(list_transform(string_split(regexp_replace({body}, '<[^>]*>', chr(1), 'g'), chr(1)), lambda x: regexp_replace({plain}, '^\\s+|\\s+$', '', 'g')), lambda x: x <> ''), chr(10))"


PARSED = f"""parsed AS MATERIALIZED (SELECT page_id, url, html, {TITLE} AS title, {sql_parsed_text()} AS own, {sql_page_text()} AS plain FROM pages),
 texts AS MATERIALIZED (SELECT page_id, url, html, title, CASE WHEN {sql_n_words('own')} >= 30 THEN own ELSE plain END AS text, {sql_n_words('own')} >= 30 AS enough FROM parsed)"""


# --- text and cleaning

@query(f"SELECT doc_id, {sql_n_words('text')}::BIGINT AS n_words, length(text)::BIGINT AS n_chars_seen, round({sql_distinct('text')}, 6) AS distinct_ratio, round({sql_ratio('text', chr(92) + 'p{L}')}, 6) AS alpha_ratio, round({sql_ratio('text', chr(92) + 'p{Nd}')}, 6) AS digit_ratio, round({sql_mean_word('text')}, 6) AS mean_word_length FROM documents")
def doc_text_stats(spark, sf_dir):
    t = F.col("text")
    return documents(spark, sf_dir).select("doc_id", X.word_count(t).alias("n_words"), F.length(t).cast("long").alias("n_chars_seen"), rounded(X.distinct_ratio(t)).alias("distinct_ratio"), rounded(X.alpha_ratio(t)).alias("alpha_ratio"), rounded(X.digit_ratio(t)).alias("digit_ratio"), rounded(X.mean_word_length(t)).alias("mean_word_length"))


@query(f"SELECT doc_id, sha256({sql_squeeze('text')}) AS key FROM documents")
def normalize_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.sha2(normalize(F.col("text"), html=False), 256).alias("key"))


#: Patterns that occur in the tables, since the stock ones don't; the operator is the same.
SAMPLE_GROUPS = {"articles": (1.0, ("the", "die", "los")), "endings": (0.5, ("tion", "mente"))}
SAMPLE_INSTANT = (r"^\s*of\s",)
SAMPLE = CleanConfig(threshold=0.45, groups=SAMPLE_GROUPS, instant=SAMPLE_INSTANT, html=False)


def sql_density(t: str) -> str:
    weighted = sql_sum([f"{w} * ({sql_sum([f'len(regexp_extract_all({t}, {sql_text(p)}, 0, {sql_text(chr(105))}))' for p in ps])})" for w, ps in SAMPLE_GROUPS.values()])
    return f"CASE WHEN regexp_matches({t}, {sql_text(SAMPLE_INSTANT[0])}, 'i') THEN 999.0 ELSE ({weighted}) / greatest({sql_n_words(t)}, 1) END"


CLEANED = f"""WITH n AS (SELECT doc_id, {sql_squeeze('text')} AS t FROM documents), l AS (SELECT *, CASE WHEN length(t) < 80 THEN 'too_short' WHEN length(t) > 2000000 THEN 'too_long' END AS len FROM n),
 d AS (SELECT *, len IS NULL AND row_number() OVER (PARTITION BY len IS NULL, t ORDER BY doc_id) > 1 AS again FROM l),
 s AS (SELECT *, CASE WHEN len IS NULL AND NOT again THEN {sql_density('t')} ELSE 0.0 END AS score FROM d),
 a AS (SELECT *, CASE WHEN len IS NOT NULL THEN len WHEN again THEN 'duplicate' WHEN score >= 0.45 THEN 'dropped' ELSE 'kept' END AS action FROM s) """


@query(CLEANED + "SELECT action, count(*) AS n FROM a GROUP BY action")
def clean_action_counts(spark, sf_dir):
    return action_counts(clean(documents(spark, sf_dir), SAMPLE, order="doc_id"))


@query(CLEANED + "SELECT doc_id, action, action = 'kept' AS kept, round(score, 6) AS score, sha256(t) AS key FROM a")
def clean_documents(spark, sf_dir):
    done = clean(documents(spark, sf_dir), SAMPLE, order="doc_id")
    return done.select("doc_id", "action", "kept", rounded(F.col("score")).alias("score"), F.sha2("text", 256).alias("key"))


@query(f"SELECT doc_id, round({sql_density('text')}, 6) AS density FROM documents")
def refusal_density(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", rounded(refusal_score(F.col("text"), SAMPLE_GROUPS, SAMPLE_INSTANT)).alias("density"))


STOCK_REFUSALS = [(w, p) for w, ps in V.REFUSALS.values() for p in ps]


@query("SELECT conv_id, turn, round(CASE WHEN " + " OR ".join(f"regexp_matches(text, {sql_text(p.removesuffix(chr(92) + 'b'))}, 'i')" for p in V.INSTANT_DROPS) + f" THEN 999.0 ELSE ({sql_sum([f'{w} * len(regexp_extract_all(text, {sql_text(p)}, 0, {sql_text(chr(105))}))' for w, p in STOCK_REFUSALS])}) / greatest({sql_n_words('text')}, 1) END, 6) AS density FROM conversations")
def stock_refusals(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", rounded(refusal_score(F.col("text"))).alias("density"))


@query(f"SELECT doc_id FROM documents WHERE regexp_matches(text, {sql_text(SAMPLE_INSTANT[0])}, 'i')")
def instant_drop(spark, sf_dir):
    return documents(spark, sf_dir).where(X.matches(F.col("text"), SAMPLE_INSTANT[0])).select("doc_id")


@query("SELECT doc_id, sha256(regexp_replace(text, 'tion|mente', '[REMOVED]', 'gi')) AS key FROM documents")
def redact_spans(spark, sf_dir):
    hits = refusal_hits(CleanConfig(groups={"endings": (1.0, ("tion", "mente"))}, instant=()))
    return documents(spark, sf_dir).select("doc_id", F.sha2(redact(F.col("text"), hits(F.col("text"))), 256).alias("key"))


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def exact_dedup_clean(spark, sf_dir):
    return dedup.exact_dedup(documents(spark, sf_dir), "doc_id").select("doc_id")


NORMAL = "lower(regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g'))"


@query(f"SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY {NORMAL} ORDER BY doc_id) = 1")
def exact_dedup_normalized(spark, sf_dir):
    return dedup.exact_dedup(documents(spark, sf_dir), "doc_id", normalized=True).select("doc_id")


@query(f"WITH k AS (SELECT {NORMAL} AS k FROM documents) SELECT count(*) AS total, count(DISTINCT k) AS kept, count(*) - count(DISTINCT k) AS dropped, round((count(*) - count(DISTINCT k)) / count(*), 6) AS dropped_share FROM k")
def dedup_stats(spark, sf_dir):
    keyed = documents(spark, sf_dir).select(X.normalized_key(F.col("text")).alias("k"))
    return reports.dedup_stats(keyed, "k").withColumn("dropped_share", rounded(F.col("dropped_share")))


# --- near duplicates

SETS = """WITH RECURSIVE tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}\\p{M}_]+') AS w FROM documents),
 sets AS MATERIALIZED (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 3 THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] ELSE w END)) AS s FROM tok WHERE len(w) > 0),
 reps AS MATERIALIZED (SELECT min(doc_id) AS rep, s FROM sets GROUP BY s),
 grams AS MATERIALIZED (SELECT rep, len(s) AS n, unnest(s) AS g FROM reps),
 common AS (SELECT x.rep AS a, y.rep AS b, count(*) AS c, any_value(x.n) AS na, any_value(y.n) AS nb FROM grams x JOIN grams y ON x.g = y.g AND x.rep < y.rep GROUP BY 1, 2),
 pairs AS MATERIALIZED (SELECT a, b, c / (na + nb - c) AS similarity FROM common WHERE c / (na + nb - c) >= 0.92 - 1e-12) """


@query(SETS + "SELECT a, b, round(similarity, 6) AS similarity FROM pairs")
def jaccard_pairs(spark, sf_dir):
    """Pairs between representatives of equal shingle sets; jaccard_clusters has the membership."""
    return dedup.jaccard_pairs_of(documents(spark, sf_dir)).withColumn("similarity", rounded(F.col("similarity")))


@query(SETS + """, sym AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), reach AS (SELECT rep AS a, rep AS b FROM reps UNION SELECT reach.a, sym.b FROM reach JOIN sym ON sym.a = reach.b)
 SELECT d.doc_id AS id, coalesce(c.cluster, d.doc_id) AS cluster FROM documents d LEFT JOIN sets USING (doc_id) LEFT JOIN reps ON reps.s = sets.s LEFT JOIN (SELECT a, min(b) AS cluster FROM reach GROUP BY a) c ON c.a = reps.rep""")
def jaccard_clusters(spark, sf_dir):
    return dedup.jaccard_clusters(documents(spark, sf_dir))


def sql_walk(order: str, fate: str) -> str:
    """The sequential rule as a recursion over the few rows that it concerns, in order: rows (k, id, other) of `order`, each adding fate's ids to those gone."""
    return f"""walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS gone UNION ALL SELECT w.k + 1, {fate} FROM walk w JOIN {order} i ON i.k = w.k + 1),
 last AS (SELECT gone FROM walk ORDER BY k DESC LIMIT 1) """


#: A row goes if an earlier one that is still there is similar.
GREEDY = SETS + """, alike AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM sets x JOIN reps rx ON rx.s = x.s JOIN (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs UNION ALL SELECT rep, rep FROM reps) p ON p.a = rx.rep JOIN reps ry ON ry.rep = p.b JOIN sets y ON y.s = ry.s AND x.doc_id < y.doc_id),
 steps AS MATERIALIZED (SELECT row_number() OVER (ORDER BY b) AS k, b AS id, list(a) AS other FROM alike GROUP BY b), """


@query(GREEDY + sql_walk("steps", "CASE WHEN len(list_filter(i.other, lambda x: NOT list_contains(w.gone, x))) > 0 THEN list_append(w.gone, i.id) ELSE w.gone END") + "SELECT doc_id AS ord FROM documents, last WHERE NOT list_contains(gone, doc_id)")
def jaccard_greedy(spark, sf_dir):
    return dedup.earliest_jaccard_dedup(documents(spark, sf_dir).select(F.col("doc_id").alias("ord"), "text"))


COSINES = """WITH u AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), p AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS similarity FROM u q JOIN u v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0) """


@query(COSINES + "SELECT query_id, vec_id, round(similarity, 6) AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(similarity, 12) DESC, vec_id)::INT AS rank FROM p) WHERE rank <= 5")
def cosine_topk(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings")
    return dedup.cosine_topk(v, v.where("vec_id % 100 = 0")).withColumn("similarity", rounded(F.col("similarity")))


@query("""WITH RECURSIVE u AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.42),
 reach AS (SELECT vec_id AS a, vec_id AS b FROM u UNION SELECT reach.a, p.b FROM reach JOIN p ON p.a = reach.b) SELECT a AS id, min(b) AS cluster FROM reach GROUP BY a""")
def cosine_clusters(spark, sf_dir):
    return dedup.cosine_clusters(table(spark, sf_dir, "embeddings"), 0.42)


#: A row that is still there looks at its five nearest, most similar first, and the first later one within the threshold goes.
NEAREST = """WITH RECURSIVE u AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
 s AS (SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(x.e, y.e) AS sim FROM u x JOIN u y ON true),
 n AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(sim, 6) DESC, b) <= 6),
 f AS (SELECT a, b FROM n WHERE b > a AND sim >= 0.42 QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(sim, 6) DESC, b) = 1),
 steps AS MATERIALIZED (SELECT row_number() OVER (ORDER BY a) AS k, a AS id, b AS other FROM f), """


@query(NEAREST + sql_walk("steps", "CASE WHEN list_contains(w.gone, i.id) THEN w.gone ELSE list_append(w.gone, i.other) END") + "SELECT vec_id AS ord FROM embeddings, last WHERE NOT list_contains(gone, vec_id)")
def cosine_greedy(spark, sf_dir):
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ord"), "embedding", F.lit(1.0).alias("weight"))
    return dedup.greedy_vector_dedup(v, 0.42, buffer=None)


# --- scores and types

@query(f"SELECT doc_id, round({sql_quality('text')}, 6) AS quality FROM documents")
def quality_score(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", rounded(S.quality_score(F.col("text"))).alias("quality"))


PAGES = f"WITH p AS (SELECT page_id, url, {sql_page_text()} AS t FROM pages) "


def pages_text(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", "url", html.page_text(F.col("html")).alias("t"))


@query(PAGES + f"SELECT page_id, round({sql_signal('url', 't')}, 6) AS signal FROM p")
def signal_score(spark, sf_dir):
    return pages_text(spark, sf_dir).select("page_id", rounded(S.signal_score(F.col("url"), F.col("t"), penalties=SIGNAL_PENALTIES)).alias("signal"))


#: Domain rules that the tables' hosts meet; a domain that none fits has weight 0.8 and is general_web.
SAMPLE_DOMAINS = (("example.org", 2.0, "reference"), ("*.c?m", 0.7, "shop"), ("ple.nets", 0.5, "forum"))


@query(f"SELECT page_id, {DOMAIN} AS domain, CASE WHEN contains({DOMAIN}, 'example.org') THEN 2.0 WHEN {DOMAIN} GLOB '*.c?m' THEN 0.7 WHEN contains({DOMAIN}, 'ple.nets') THEN 0.5 ELSE 0.8 END::DOUBLE AS weight, CASE WHEN contains({DOMAIN}, 'example.org') THEN 'reference' WHEN {DOMAIN} GLOB '*.c?m' THEN 'shop' WHEN contains({DOMAIN}, 'ple.nets') THEN 'forum' ELSE 'general_web' END AS category FROM pages")
def domain_rules(spark, sf_dir):
    d = X.registered_domain(F.col("url"))
    weight, category = S.domain_rule(d, SAMPLE_DOMAINS)
    return pages(spark, sf_dir).select("page_id", d.alias("domain"), weight.cast("double").alias("weight"), category.alias("category"))


RULES = f"""WITH h AS (SELECT page_id, {NETLOC} AS host FROM pages), r AS (SELECT page_id AS ord, CASE page_id % 4 WHEN 0 THEN substr(host, 3, 5) WHEN 1 THEN '*' || substr(host, length(host) - 8) WHEN 2 THEN substr(host, 1, 4) || '*' ELSE '?' || substr(host, 2, 6) || '*.o[a-r]g' END AS pattern, (page_id % 7) / 2.0 AS weight, 'c' || (page_id % 5) AS category FROM h WHERE page_id % 2 = 1 OR page_id % 6 = 0)"""


@query(RULES + """, f AS (SELECT h.host, min(r.ord) AS ord FROM (SELECT DISTINCT host FROM h) h JOIN r ON contains(h.host, r.pattern) OR h.host GLOB r.pattern GROUP BY h.host)
 SELECT h.page_id, coalesce(r.weight, 0.8)::DOUBLE AS weight, coalesce(r.category, 'general_web') AS category FROM h LEFT JOIN f ON f.host = h.host LEFT JOIN r ON r.ord = f.ord""")
def rule_table(spark, sf_dir):
    """Rules made of the hosts of most pages, in the order of the pages: parts, endings, beginnings and shell patterns."""
    hosts = pages(spark, sf_dir).select("page_id", X.netloc(F.col("url")).alias("domain"))
    n, h = F.col("page_id"), F.col("domain")
    pattern = F.when(n % 4 == 0, F.substring(h, 3, 5)).when(n % 4 == 1, F.concat(F.lit("*"), F.substring(h, F.length(h) - 8, F.lit(9)))).when(n % 4 == 2, F.concat(F.substring(h, 1, 4), F.lit("*"))).otherwise(F.concat(F.lit("?"), F.substring(h, 2, 6), F.lit("*.o[a-r]g")))
    table_ = hosts.where("page_id % 2 = 1 OR page_id % 6 = 0").select(n.alias("ord"), pattern.alias("pattern"), ((n % 7) / 2.0).alias("weight"), F.concat(F.lit("c"), (n % 5).cast("string")).alias("category"))
    return rules.apply_rules(hosts, written(table_, "rules")).select("page_id", F.col("domain_weight").alias("weight"), "category")


@query(f"SELECT page_id, {sql_case([(f'regexp_matches(url, {sql_text(p)})', sql_text(k)) for p, k in V.URL_TYPES], sql_text('unknown'))} AS content_type, {sql_case([('lower(regexp_extract(url, ' + sql_text('^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)') + f', 1)) LIKE {sql_text(chr(37) + k)}', sql_text(v)) for k, v in V.CODE_SUFFIXES.items()], sql_text(''))} AS code_language FROM pages")
def classify_url(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", X.classify_url(F.col("url")).alias("content_type"), X.code_language(F.col("url")).alias("code_language"))


@query("SELECT doc_id, " + sql_case([(sql_sum([f"contains(lower(text), {sql_text(w)})::INT" for w in words]) + " >= 2", sql_text(k)) for words, k in V.TYPE_KEYWORDS], "'unknown'") + " AS content_type FROM documents")
def reclassify(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", X.reclassify(F.lit("unknown"), F.col("text")).alias("content_type"))


@query(f"""WITH {PARSED}, d AS (SELECT page_id, {DOMAIN} AS domain, {sql_quality('text')} AS q FROM texts WHERE {sql_n_words('text')} >= 30 QUALIFY row_number() OVER (PARTITION BY text ORDER BY page_id) = 1)
 SELECT page_id, domain, round(0.8 * 0.8 * q, 6) AS final_weight FROM d""")
def page_weights(spark, sf_dir):
    docs = readers.page_documents(pages(spark, sf_dir))
    return docs.select(F.col("ord").alias("page_id"), "domain", rounded(F.col("final_weight")).alias("final_weight"))


@query("SELECT page_id, regexp_matches(url, '(?i)^https?://') AND " + NETLOC + " <> '' AND NOT contains(" + NETLOC + ", '@') AS public, NOT regexp_matches(url, " + sql_text("|".join(V.URL_BLOCK)) + ") AND regexp_matches(url, 'example') AS allowed FROM pages")
def url_guards(spark, sf_dir):
    u = F.col("url")
    return pages(spark, sf_dir).select("page_id", X.public_http_url(u).alias("public"), X.allowed_url(u, ("example",)).alias("allowed"))


# --- pages

@query(f"SELECT page_id, {TITLE} AS title, sha256({sql_page_text()}) AS key, sha256(regexp_replace(html, '<[^>]+>', ' ', 'g')) AS stripped FROM pages")
def page_texts(spark, sf_dir):
    h = F.col("html")
    return pages(spark, sf_dir).select("page_id", html.page_title(h).alias("title"), F.sha2(html.page_text(h), 256).alias("key"), F.sha2(X.strip_tags(h), 256).alias("stripped"))


ORIGIN = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)"
LINKS = f"""WITH RECURSIVE h AS (SELECT page_id, url, unnest(list_distinct(regexp_extract_all(html, '(?i)<a\\s[^>]*href=["'']([^"''#]*)', 1))) AS href FROM pages),
 r AS (SELECT page_id, url, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN href WHEN starts_with(href, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*:)', 1) || href WHEN starts_with(href, '/') THEN {ORIGIN} || href ELSE {ORIGIN} || '/' || href END AS link FROM h),
 links AS MATERIALIZED (SELECT DISTINCT page_id, url, link FROM r WHERE starts_with(link, 'http')) """


@query(LINKS + "SELECT page_id, url, link FROM links")
def extract_links(spark, sf_dir):
    return html.links(pages(spark, sf_dir))


@query(LINKS + """, seeds AS (SELECT DISTINCT url FROM pages WHERE page_id < 5), walk AS (SELECT url, 0 AS depth FROM seeds UNION SELECT l.link, w.depth + 1 FROM walk w JOIN links l ON l.url = w.url WHERE w.depth < 3)
 SELECT url, min(depth)::INT AS depth FROM walk GROUP BY url""")
def bfs_frontier(spark, sf_dir):
    """The seeds are the crawl's own: its first five pages."""
    crawled = pages(spark, sf_dir)
    edges = html.links(crawled).select(F.col("url").alias("src"), F.col("link").alias("dst"))
    return frontier.frontier(crawled.where("page_id < 5"), edges, 3)


@query(f"""WITH {PARSED} SELECT page_id, {sql_entities("title")} AS title, length(own)::INT AS n_chars, len(regexp_extract_all(html, '(?i)<a\\s[^>]*href="[^"]'))::INT AS n_links FROM parsed""")
def parsed_pages(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", html.extract(F.col("html")).alias("x")).select("page_id", "x.title", F.length("x.text").alias("n_chars"), F.size("x.links").alias("n_links"))


GATED = """WITH e AS (SELECT user_id % 50 AS domain, event_id AS ord, value / 100.0 AS score FROM events), r AS (SELECT *, row_number() OVER w AS seq, avg(score) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS rolling FROM e WINDOW w AS (PARTITION BY domain ORDER BY ord)),
 g AS (SELECT *, min(CASE WHEN seq >= 10 AND rolling < 0.35 THEN seq END) OVER (PARTITION BY domain ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bad FROM r) """


def gate_input(spark, sf_dir):
    return table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("domain"), F.col("event_id").alias("ord"), (F.col("value") / 100.0).alias("score"))


@query(GATED + "SELECT domain, ord, coalesce(seq <= bad, true) AS admitted FROM g")
def domain_gate(spark, sf_dir):
    return gate.signal_gate(gate_input(spark, sf_dir)).select("domain", "ord", "admitted")


@query(GATED + "SELECT DISTINCT domain FROM g WHERE seq >= 10 AND rolling < 0.35")
def abandoned_domains(spark, sf_dir):
    return gate.abandoned(gate.signal_gate(gate_input(spark, sf_dir)))


@query(f"SELECT page_id, {DOMAIN} AS domain FROM pages QUALIFY row_number() OVER (PARTITION BY {DOMAIN} ORDER BY page_id) <= 20")
def domain_cap(spark, sf_dir):
    crawled = pages(spark, sf_dir).select("page_id", X.registered_domain(F.col("url")).alias("domain"))
    return gate.domain_cap(crawled, 20, order="page_id")


# --- weights and samples

WEIGHT = "(doc_id % 7) * 0.45"


def weighted(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", ((F.col("doc_id") % 7) * 0.45).alias("final_weight"))


def sql_copies(strategy: str) -> str:
    u = sql_uniform("doc_id")
    n = f"CASE WHEN w >= 1 OR u < w THEN 1 ELSE 0 END" if strategy == "downsample" else "floor(w)::INT + CASE WHEN u < w - floor(w) THEN 1 ELSE 0 END"
    return f"WITH d AS (SELECT doc_id, {WEIGHT} AS w, {u} AS u FROM documents) SELECT doc_id, unnest(range(1, ({n}) + 1))::INT AS copy_no FROM d"


@query(sql_copies("upsample"))
def upsample(spark, sf_dir):
    return weighting.reweight(weighted(spark, sf_dir), strategy="upsample").select("doc_id", "copy_no")


@query(sql_copies("downsample"))
def downsample(spark, sf_dir):
    return weighting.reweight(weighted(spark, sf_dir), strategy="downsample").select("doc_id", "copy_no")


@query(sql_copies("both"))
def resample_both(spark, sf_dir):
    return weighting.reweight(weighted(spark, sf_dir), strategy="both").select("doc_id", "copy_no")


@query(f"WITH c AS ({sql_copies('upsample')}) SELECT (SELECT count(*) FROM documents) AS docs_in, (SELECT round(sum({WEIGHT}), 4) FROM documents)::DOUBLE AS total_weight, (SELECT round(avg({WEIGHT}), 6) FROM documents)::DOUBLE AS avg_weight, (SELECT count(*) FROM c) AS docs_out, round((SELECT count(*) FROM c) / (SELECT count(*) FROM documents), 6) AS expansion")
def weight_stats(spark, sf_dir):
    docs = weighted(spark, sf_dir)
    out = reports.weight_stats(weighting.reweight(docs), docs)
    return out.select("docs_in", rounded(F.col("total_weight"), 4).alias("total_weight"), rounded(F.col("avg_weight")).alias("avg_weight"), "docs_out", rounded(F.col("expansion")).alias("expansion"))


@query("SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id::VARCHAR), doc_id LIMIT 100")
def fixed_sample(spark, sf_dir):
    """The sampler's own size is its feature."""
    return weighting.fixed_sample(documents(spark, sf_dir).select("doc_id"), 100)


@query("WITH p AS (SELECT doc_id, (row_number() OVER (ORDER BY md5('42|' || doc_id::VARCHAR), doc_id) - 1)::BIGINT AS position, count(*) OVER () AS n FROM documents) SELECT doc_id, position, CASE WHEN position < least(greatest(1, floor(n * 0.005)), greatest(n - 1, 1)) THEN 'val' ELSE 'train' END AS split FROM p")
def train_val_split(spark, sf_dir):
    return weighting.train_val_split(documents(spark, sf_dir).select("doc_id"))


# --- tokens and shards

@query("SELECT doc_id, (octet_length(encode(text)) + 1)::BIGINT AS n_tokens FROM documents")
def byte_token_counts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", shards.byte_token_count(F.col("text")).alias("n_tokens"))


BYTES = "list_transform(range(0, octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::INT + 6)"


@query("SELECT doc_id, n_tokens, md5(regexp_replace(hex(encode(text)), '(..)', '\\1,', 'g')) AS key FROM (SELECT doc_id, text, (octet_length(encode(text)) + 1)::BIGINT AS n_tokens FROM documents)")
def byte_tokens(spark, sf_dir):
    t = documents(spark, sf_dir).select("doc_id", shards.byte_tokens(F.col("text")).alias("tokens"))
    shown = F.transform(F.slice("tokens", F.lit(1), F.size("tokens") - 1), lambda x: F.concat(F.lpad(F.hex(x - V.BYTE_BASE), 2, "0"), F.lit(",")))
    return t.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.md5(F.array_join(shown, "")).alias("key"))


SHARD = 200_000
OFFSETS = f"WITH c AS (SELECT doc_id, (octet_length(encode(text)) + 1)::BIGINT AS n_tokens FROM documents), o AS (SELECT doc_id, n_tokens, coalesce(sum(n_tokens) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS token_offset FROM c), s AS (SELECT *, (token_offset // {SHARD})::BIGINT AS first_shard, ((token_offset + n_tokens - 1) // {SHARD})::BIGINT AS last_shard FROM o) "


def counted(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", shards.byte_token_count(F.col("text")).alias("n_tokens"))


@query(OFFSETS + "SELECT doc_id, n_tokens, token_offset, first_shard, last_shard FROM s")
def shard_offsets(spark, sf_dir):
    return shards.shard_offsets(counted(spark, sf_dir), ["doc_id"], shard_size=SHARD).select("doc_id", "n_tokens", "token_offset", "first_shard", "last_shard")


@query(OFFSETS + f", e AS (SELECT *, unnest(range(first_shard, last_shard + 1)) AS shard FROM s) SELECT shard::BIGINT AS shard, sum(least(n_tokens, (shard + 1) * {SHARD} - token_offset) - greatest(0, shard * {SHARD} - token_offset))::BIGINT AS tokens, count(*) AS parts FROM e GROUP BY shard")
def shard_pack(spark, sf_dir):
    return shards.shard_stats(shards.pack_texts(documents(spark, sf_dir), ["doc_id"], shard_size=SHARD))


@query("SELECT doc_id AS shard, unnest(range(0, (octet_length(encode(text)) + 1 - 258) + 1, 256))::INT AS start FROM documents WHERE octet_length(encode(text)) + 1 > 257")
def train_windows(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("shard"), shards.byte_tokens(F.col("text")).alias("tokens"))
    return shards.train_windows(docs, 256).where((F.size("x") == 256) & (F.size("y") == 256)).select("shard", "start")


@query("WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '\\S+')) AS word FROM documents) SELECT word, count(*) AS n FROM w GROUP BY word")
def word_counts(spark, sf_dir):
    return bpe.word_counts(documents(spark, sf_dir))


# --- sources, reports

@query("SELECT source, count(*) AS n FROM (SELECT 'web' AS source FROM pages UNION ALL SELECT 'huggingface' FROM documents) GROUP BY source")
def source_union(spark, sf_dir):
    web = pages(spark, sf_dir).select(F.col("page_id").alias("ord"), "url")
    return readers.union_sources({"huggingface": documents(spark, sf_dir).select(F.col("doc_id").alias("ord")), "web": web}).groupBy("source").agg(F.count("*").alias("n"))


@query(f"SELECT source, count(*) AS n_docs, sum({sql_n_words('text')})::BIGINT AS n_words, sum(length(text))::BIGINT AS n_chars, count(*) FILTER ({sql_n_words('text')} < 30) AS n_short FROM documents GROUP BY source")
def source_stats(spark, sf_dir):
    return reports.source_stats(documents(spark, sf_dir))


@query("WITH e AS (SELECT user_id % 50 AS domain, event_id, value / 100.0 AS score, row_number() OVER (PARTITION BY user_id % 50 ORDER BY event_id DESC) AS n FROM events), a AS (SELECT domain, avg(score) FILTER (n <= 20) AS s, count(*) AS n_pages FROM e GROUP BY domain) SELECT domain, round(s, 6) AS avg_score, n_pages, CASE WHEN s >= 0.6 THEN 'high' WHEN s >= 0.35 THEN 'medium' ELSE 'low' END AS bucket FROM a")
def domain_report(spark, sf_dir):
    return reports.domain_report(gate_input(spark, sf_dir)).withColumn("avg_score", rounded(F.col("avg_score")))


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 150")
def event_tail(spark, sf_dir):
    """The last 150 events: the size is the report's feature."""
    return reports.tail(table(spark, sf_dir, "events"), 150, ["ts", "event_id"]).select("event_id", "event_type")


@query("SELECT c_custkey AS dataset_id, CASE WHEN bool_or(o_orderpriority LIKE '1%' AND o_orderstatus = 'F') THEN 'COMPLETE' WHEN bool_or(o_orderpriority LIKE '2%' AND o_orderstatus = 'F') THEN 'TRAINED' WHEN bool_or(o_orderstatus = 'O') THEN 'RUNNING' ELSE 'COLLECTED' END AS state FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def session_state(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "O", "running").otherwise("pending")
    stage = F.when(F.col("o_orderpriority").startswith("1"), "export").when(F.col("o_orderpriority").startswith("2"), "train").otherwise("crawl")
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return reports.session_state(joined.select(F.col("c_custkey").alias("dataset_id"), stage.alias("stage"), status.alias("status")))


@query("SELECT doc_id, coalesce(l.quality, -1) AS words FROM documents LEFT JOIN labels l USING (doc_id)")
def latest_corpus(spark, sf_dir):
    base = documents(spark, sf_dir).select("doc_id", F.lit(-1).alias("words"))
    return reports.latest_available([(2, base), (4, table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("words")))], "doc_id")


@query("SELECT event_type AS source, count(*) FILTER (user_id % 4 = 0) AS fetched, count(*) FILTER (user_id % 4 = 1) AS skipped, count(*) FILTER (user_id % 4 = 2) AS error, count(*) FILTER (user_id % 4 = 3) AS abandoned FROM events GROUP BY event_type")
def crawl_stats(spark, sf_dir):
    outcome = F.element_at(F.array(*map(F.lit, ("fetched", "skipped", "error", "abandoned"))), (F.col("user_id") % 4 + 1).cast("int"))
    return reports.crawl_stats(table(spark, sf_dir, "events").select(F.col("event_type").alias("source"), outcome.alias("outcome")))


@query(f"SELECT lang AS dataset_id, count(*) AS documents, sum({sql_n_words('text')})::BIGINT AS words FROM documents GROUP BY lang")
def session_stats(spark, sf_dir):
    return reports.session_stats(documents(spark, sf_dir).select(F.col("lang").alias("dataset_id"), "text"))


@query(f"SELECT string_split({NETLOC}, '.')[-1] AS root, count(*) AS files, sum(octet_length(encode(html)))::BIGINT AS bytes FROM pages GROUP BY 1")
def output_inventory(spark, sf_dir):
    files = pages(spark, sf_dir).select(F.concat(F.lit("file:/"), F.element_at(F.split(X.netloc(F.col("url")), r"\."), -1), F.lit("/x")).alias("path"), F.octet_length("html").alias("size"))
    return reports.output_inventory(files, 1)


@query("SELECT o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) > 3")
def superseded_artifacts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("kind"), F.col("o_orderkey").alias("step"))
    return reports.superseded(rows).select(F.col("step").alias("o_orderkey"))


@query("SELECT avg(value / 50) AS mean_loss, exp(least(avg(value / 50), 20)) AS perplexity FROM events".replace("avg(value / 50) AS", "round(avg(value / 50), 6) AS").replace("exp(least(avg(value / 50), 20)) AS", "round(exp(least(avg(value / 50), 20)), 4) AS"))
def training_perplexity(spark, sf_dir):
    out = reports.perplexity(table(spark, sf_dir, "events").select((F.col("value") / 50).alias("loss")))
    return out.select(rounded(F.col("mean_loss")).alias("mean_loss"), rounded(F.col("perplexity"), 4).alias("perplexity"))


@query("SELECT max(doc_id) + 1 AS next_id FROM documents")
def next_session_id(spark, sf_dir):
    return reports.next_id(documents(spark, sf_dir), "doc_id")


@query("SELECT c_custkey AS group_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def unseeded_groups(spark, sf_dir):
    return reports.unseeded_groups(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("group_id")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("group_id")))


@query("SELECT o_orderkey, round(CASE WHEN o_custkey > 0 THEN 1.0 + least(log10(o_custkey + 1) / 5, 0.4) ELSE 1.0 END, 6) AS starred, round(least(1.0 + CASE WHEN coalesce(c_nationkey, 0) > 0 THEN least(log10(c_nationkey + 1) / 6, 0.3) ELSE 0 END, 5.0), 6) AS cited FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0")
def bonuses(spark, sf_dir):
    counts = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    joined = table(spark, sf_dir, "orders").join(counts, "o_custkey", "left")
    return joined.select("o_orderkey", rounded(S.star_bonus(F.lit(1.0), F.col("o_custkey"))).alias("starred"), rounded(S.citation_bonus(F.lit(1.0), F.coalesce("c_nationkey", F.lit(0)))).alias("cited"))


@query("SELECT label_quality, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM (SELECT d.n_chars, coalesce(quality, -1) AS label_quality FROM documents d LEFT JOIN labels USING (doc_id)) GROUP BY label_quality")
def label_join(spark, sf_dir):
    joined = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.groupBy(F.coalesce("quality", F.lit(-1)).alias("label_quality")).agg(F.count("*").alias("n"), F.sum("n_chars").cast("long").alias("n_chars"))


@query("SELECT count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM documents")
def json_round_trip(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    path = new_path(spark, "documents-json")
    docs.write.json(path)
    return readers.json_lines(spark, path).agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("long").alias("n_chars"))


@query("SELECT 'documents' AS kind, count(*) AS n_rows, true AS valid FROM documents")
def artifact_manifest(spark, sf_dir):
    path = new_path(spark, "artifact")
    manifest = sinks.write_artifact(documents(spark, sf_dir), path, "documents")
    return spark.createDataFrame([(manifest["kind"], manifest["rows"], sinks.valid_artifact(spark, path))], "kind string, n_rows bigint, valid boolean")


@query()
def stages_run(spark, sf_dir):
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    packed = stages.run(spark, docs, new_path(spark, "run"), stages.RunConfig(shard_size=500_000))
    return packed.groupBy("split", "shard").agg(F.sum(F.size("tokens")).cast("long").alias("tokens"))


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def top_per_group(spark, sf_dir):
    """The first three of each group: the size is the operator's feature."""
    return crawl.top_per_group(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey")


ROBOTS = [("*", False, "/p"), ("*", True, "/pa"), ("other", False, "/")]
URL_PATH = "coalesce(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1), ''), '/')"


@query(f"SELECT page_id FROM pages WHERE NOT (starts_with({URL_PATH}, '/p') AND NOT starts_with({URL_PATH}, '/pa'))")
def robots_allowed(spark, sf_dir):
    crawled = pages(spark, sf_dir).select("page_id", "url")
    each = F.array(*(F.struct(F.lit(a).alias("agent"), F.lit(b).alias("allow"), F.lit(c).alias("prefix")) for a, b, c in ROBOTS))
    rules = crawled.select(X.netloc(F.col("url")).alias("host")).distinct().select("host", F.inline(each))
    return crawl.robots_allow(crawled, rules).select("page_id")


@query("SELECT page_id FROM pages WHERE page_id % 3 <> 0 AND octet_length(encode(html)) <= 20000")
def fetched_pages(spark, sf_dir):
    status = F.when(F.col("page_id") % 3 == 0, 404).otherwise(200)
    responses = pages(spark, sf_dir).select("page_id", "html", status.alias("status"), F.lit("Text/HTML; charset=utf-8").alias("content_type"))
    return crawl.fetched_ok(responses, 20_000).select("page_id")


@query("SELECT doc_id FROM documents WHERE lang = 'en'")
def english_documents(spark, sf_dir):
    return documents(spark, sf_dir).where(crawl.english(F.col("lang"))).select("doc_id")


@query("SELECT row_number() OVER (ORDER BY n_nationkey)::BIGINT AS dataset_id, regexp_replace(n_name, ' ', '-', 'g') AS name, n_nationkey::VARCHAR AS group_id, 'COLLECTED' AS state FROM nation")
def seeded_sessions(spark, sf_dir):
    groups = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_nationkey").cast("string").alias("group_id"), F.col("n_name").alias("name"))
    made = sessions.seed(sessions.empty(spark), groups)
    return made.join(reports.session_state(sessions.stage_rows(made)), "dataset_id").select(F.col("dataset_id").cast("long").alias("dataset_id"), "name", "group_id", "state")


def bpe_token_counts(spark, sf_dir):
    """Counts under a public byte-level vocabulary; registered only where its files are."""
    import public_tokenizers

    encoded = bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), 50256)
    return encoded.select(F.col("id").alias("doc_id"), F.size("tokens").cast("long").alias("n_tokens"))


if importlib.util.find_spec("public_tokenizers"):
    query()(bpe_token_counts)


# --- streams, each drained over the whole table

def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(f"{sf_dir}/events.parquet*")


def drained(df: DataFrame) -> DataFrame:
    """What a stream has appended when its input is read up."""
    spark = df.sparkSession
    path = new_path(spark, "stream")
    df.writeStream.outputMode("append").option("checkpointLocation", new_path(spark, "stream-state")).trigger(availableNow=True).format("parquet").start(path).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def drained_whole(df: DataFrame) -> DataFrame:
    """The whole result table of a stream when its input is read up, windows that the watermark hasn't closed included."""
    spark = df.sparkSession
    path = new_path(spark, "stream")

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    df.writeStream.outputMode("complete").option("checkpointLocation", new_path(spark, "stream-state")).trigger(availableNow=True).foreachBatch(replace).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


@query(GATED + "SELECT domain::VARCHAR AS domain, ord, coalesce(seq <= bad, true) AS admitted FROM g")
def stream_gate(spark, sf_dir):
    scored = event_stream(spark, sf_dir).select((F.col("user_id") % 50).cast("string").alias("domain"), F.col("event_id").alias("ord"), (F.col("value") / 100.0).alias("score"))
    return drained(stateful.gate(scored))


@query("SELECT event_type, user_id FROM events GROUP BY event_type, user_id")
def stream_dedup(spark, sf_dir):
    """The events by time in ten batches; what was seen in one isn't given in a later one."""
    source = new_path(spark, "events-in")
    events = table(spark, sf_dir, "events").select("ts", F.concat_ws("|", "event_type", "user_id").alias("text"), "event_type", "user_id")
    events.repartitionByRange(10, "ts").write.parquet(source)
    keyed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    return drained(stateful.first_seen(keyed).select("event_type", "user_id"))


@query(ORACLES["jaccard_clusters"])
def stream_near_copies(spark, sf_dir):
    """The documents as a stream of three batches, held against an index that is kept between them: the clusters are those of the whole table. They are dealt to the batches by filters, which shuffles no text."""
    source, folder = new_path(spark, "documents-in"), new_path(spark, "near-index")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    for k in range(3):
        docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == k).write.parquet(f"{source}/{k}")
    files = len(spark.read.schema("doc_id bigint, text string").parquet(*(f"{source}/{k}" for k in range(3))).inputFiles())
    docs = spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", -(-files // 3)).parquet(f"{source}/*")
    index = stateful.NearCopyIndex(spark, folder)
    index.of_stream(docs, new_path(spark, "stream-state")).trigger(availableNow=True).start().awaitTermination()
    return index.clusters()


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_windows(spark, sf_dir):
    """The stream's whole table, which also holds windows that the watermark hasn't closed yet."""
    return drained_whole(stateful.tumbling_counts(event_stream(spark, sf_dir), "1 hour")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", rounded(F.col("total"), 4).alias("total"))


@query("WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o) SELECT min(ts) AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k")
def stream_sessions(spark, sf_dir):
    return drained_whole(stateful.sessions(event_stream(spark, sf_dir))).select(F.col("start").cast("timestamp_ntz").alias("start"), "user_id", "n")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality by source after exact dedup."""
    kept = dedup.exact_dedup(documents(spark, sf_dir), "doc_id", normalized=True)
    return kept.groupBy("source").agg(F.count("*").alias("kept"), rounded(F.avg(S.quality_score(F.col("text")))).alias("avg_quality"))


QUERIES["source_quality"] = flagship
ORACLES["source_quality"] = f"WITH k AS (SELECT source, {sql_quality('text')} AS q FROM documents QUALIFY row_number() OVER (PARTITION BY {NORMAL} ORDER BY doc_id) = 1) SELECT source, count(*) AS kept, round(avg(q), 6) AS avg_quality FROM k GROUP BY source"
