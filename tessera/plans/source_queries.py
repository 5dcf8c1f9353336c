"""Queries of sources, sinks, sessions and smaller functions, fed from the tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expressions as X
from ..functions import scores as S
from ..functions import values as V
from ..operators import frontier, reports, shards
from ..operators.clean import CleanConfig, clean
from ..sources import crawl, readers, sinks
from ..tables import new_path, running_total
from . import queries as Q
from . import sessions
from .queries import documents, pages, query, rounded, sql_case, sql_n_words, sql_quality, sql_text, table

GITHUB = next(w for p, w, _ in V.DOMAINS if p == "github.com")
ARXIV = next(w for p, w, _ in V.DOMAINS if p == "arxiv.org")
NAME = "(doc_id::VARCHAR)"


def chosen(column: str, values: dict[str, object], default: str) -> str:
    return sql_case([(f"{column} = {sql_text(k)}", sql_text(v) if isinstance(v, str) else str(v)) for k, v in values.items()], default)


# --- lists and JSON lines

@query("SELECT url FROM pages WHERE page_id % 5 <> 0 AND url <> ''")
def text_list(spark, sf_dir):
    path = new_path(spark, "list")
    line = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("# "), "url")).otherwise(F.concat(F.lit("  "), "url", F.lit("\t")))
    pages(spark, sf_dir).select(line.alias("value")).unionByName(spark.createDataFrame([("",), ("   ",)], "value string")).write.text(path)
    return readers.text_list(spark, path)


def written_json(spark, sf_dir, malformed: bool):
    path = new_path(spark, "json")
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_id"), F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("text")).alias("text"))
    lines = docs.select(F.to_json(F.struct("*")).alias("value"))
    if malformed:
        lines = lines.unionByName(docs.select(F.concat(F.lit('{"doc_id": "'), "doc_id", F.lit('", "text": broken')).alias("value"))).unionByName(docs.select(F.lit('{"text": "no id"}').alias("value")))
    lines.write.text(path)
    return path


@query("SELECT count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM documents WHERE doc_id % 9 <> 0 AND text <> ''")
def corpus_texts(spark, sf_dir):
    return readers.corpus_texts(spark, written_json(spark, sf_dir, False)).agg(F.count("*").alias("n"), F.sum(F.length("text")).cast("long").alias("n_chars"))


@query(f"SELECT {NAME} AS doc_id, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE length(text) END::BIGINT AS n_chars FROM documents")
def lenient_texts(spark, sf_dir):
    return readers.json_lines(spark, written_json(spark, sf_dir, True), "DROPMALFORMED").select("doc_id", F.length("text").cast("long").alias("n_chars"))


# --- repositories, papers, datasets, feeds, sitemaps

SUFFIXES = (".py", ".md", ".bin", ".RS", ".sql")


def sql_suffix(name: str) -> str:
    return sql_case([(f"doc_id % 5 = {i}", sql_text(s)) for i, s in enumerate(SUFFIXES)], "''")


KINDS = {s: "source_code" if s.lower() in V.REPO_CODE_SUFFIXES else "technical_doc" if s.lower() in V.REPO_DOC_SUFFIXES else "" for s in SUFFIXES}
REPO = f"""WITH f AS (SELECT doc_id, text, {sql_suffix('')} AS suffix, 'r/' || {NAME} || {sql_suffix('')} AS path FROM documents WHERE doc_id % 11 <> 0 AND n_chars * 40 <= {V.REPO_MAX_BYTES} AND {sql_n_words('text')} >= 10),
 k AS (SELECT *, {chosen('suffix', KINDS, "''")} AS content_type, {chosen('lower(suffix)', {s: V.CODE_SUFFIXES.get(s.lower(), '') for s in map(str.lower, SUFFIXES)}, "''")} AS lang FROM f) """


@query(REPO + f"""SELECT md5(path) AS doc_id, content_type, lang AS code_language, round({GITHUB} * {chosen('content_type', V.TYPE_WEIGHTS, '0.8')} * CASE WHEN content_type = 'source_code' AND lang <> '' THEN {chosen('lang', V.LANGUAGE_WEIGHTS, '1.0')} ELSE 1.0 END * {sql_quality('text')}
 + CASE WHEN doc_id % 100 > 0 THEN least(log10(doc_id % 100 + 1) / 5, 0.4) ELSE 0 END, 6) AS final_weight FROM k WHERE content_type <> ''""")
def repository_files(spark, sf_dir):
    suffix = F.element_at(F.array(*map(F.lit, SUFFIXES)), (F.col("doc_id") % 5 + 1).cast("int"))
    blobs = documents(spark, sf_dir).select(
        F.col("doc_id").alias("ord"), F.concat(F.lit("r/"), F.col("doc_id").cast("string"), suffix).alias("path"), (F.col("n_chars") * 40).alias("size"),
        F.when(F.col("doc_id") % 11 == 0, "tree").otherwise("blob").alias("type"), "text", (F.col("doc_id") % 100).alias("stars"),
    )
    return readers.repository_files(blobs).select("doc_id", "content_type", "code_language", rounded(F.col("final_weight")).alias("final_weight"))


@query(f"SELECT md5(conv_id::VARCHAR || '/' || turn::VARCHAR) AS doc_id, sha256('Issue: ' || role || chr(10) || chr(10) || text) AS key FROM conversations WHERE turn % 3 <> 0 AND {sql_n_words('text')} >= 20")
def issue_documents(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    issues = turns.select(F.col("conv_id").alias("ord"), F.col("role").alias("title"), F.col("text").alias("body"), F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("html_url"), F.when(F.col("turn") % 3 == 0, "x").alias("pull_request"))
    return readers.issue_documents(issues).select("doc_id", F.sha2("text", 256).alias("key"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS readme FROM orders WHERE o_custkey >= 50")
def starred_repositories(spark, sf_dir):
    repositories = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("stars"), F.when(F.col("o_custkey") % 3 == 0, "short").otherwise(F.col("o_orderpriority")).alias("readme"))
    padded = repositories.withColumn("readme", F.when(F.col("readme") != "short", F.concat("readme", F.repeat(F.lit(" w"), 20))).otherwise(F.col("readme")))
    return readers.starred(padded, 50).select("o_orderkey", F.regexp_replace("readme", "( w)+$", "").alias("readme"))


@query("SELECT doc_id, sha256(text) AS key FROM documents")
def base64_bodies(spark, sf_dir):
    docs = documents(spark, sf_dir)
    coded = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "(.{60})", "$1\n")
    files = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, coded).otherwise(F.col("text")).alias("content"), F.when(F.col("doc_id") % 2 == 0, "base64").otherwise("utf-8").alias("encoding"))
    return readers.base64_bodies(files).select("doc_id", F.sha2("text", 256).alias("key"))


PAPER = f"""WITH p AS (SELECT d.*, coalesce(CASE WHEN l.quality = 1 THEN 40 + d.doc_id % 7 END, 0) AS cites FROM documents d LEFT JOIN labels l USING (doc_id) WHERE {sql_n_words('text')} >= 20),
 t AS (SELECT *, 'Title: ' || lang || chr(10) || 'Authors: ' || source || ', ' || lang || chr(10) || 'Categories: cs.' || lang || chr(10) || 'Published: 2024-01-02' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN 'DOI: 10/' || {NAME} || chr(10) ELSE '' END
  || CASE WHEN cites > 0 THEN 'Citations: ' || cites::VARCHAR || chr(10) ELSE '' END || chr(10) || 'Abstract:' || chr(10) || text AS whole FROM p) """


@query(PAPER + f"SELECT md5('https://arxiv.org/abs/' || {NAME}) AS doc_id, cites::BIGINT AS citations, sha256(whole) AS key, round(CASE WHEN cites > 0 THEN least({ARXIV} * {V.TYPE_WEIGHTS['research_paper']} * {sql_quality('whole')} + least(log10(cites + 1) / 6, 0.3), 5.0) ELSE {ARXIV} * {V.TYPE_WEIGHTS['research_paper']} * {sql_quality('whole')} END, 6) AS final_weight FROM t")
def paper_documents(spark, sf_dir):
    docs = documents(spark, sf_dir)
    key = F.col("doc_id").cast("string")
    papers = docs.select(
        F.col("doc_id").alias("ord"), key.alias("arxiv_id"), F.col("lang").alias("title"), F.col("text").alias("abstract"), F.array("source", "lang").alias("authors"), F.array(F.concat(F.lit("cs."), "lang")).alias("categories"),
        F.lit("2024-01-02T00:00:00Z").alias("published"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("10/"), key)).otherwise("").alias("doi"),
    )
    known = table(spark, sf_dir, "labels").where("quality = 1").select(key.alias("arxiv_id"), (F.col("doc_id") % 7 + 40).alias("citations"))
    return readers.paper_documents(papers, known).select("doc_id", F.col("citations").cast("long").alias("citations"), F.sha2("text", 256).alias("key"), rounded(F.col("final_weight")).alias("final_weight"))


@query(f"SELECT {NAME} AS arxiv_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'T ' || {NAME} END AS title, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'a b' END AS abstract, source || ',' || lang AS authors, 'c.' || lang AS categories, CASE WHEN doc_id % 5 = 0 THEN '10/x' ELSE '' END AS doi FROM documents")
def atom_entries(spark, sf_dir):
    """Feeds of about 40 entries, of which many lack a title, a summary or a DOI."""
    key = F.col("doc_id").cast("string")
    element = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    entry = F.concat(
        F.lit("<entry>"), element("id", F.concat(F.lit("http://arxiv.org/abs/"), key, F.lit("v2"))), F.when(F.col("doc_id") % 3 != 0, element("title", F.concat(F.lit("T\n "), key))).otherwise(""),
        F.when(F.col("doc_id") % 4 != 0, element("summary", F.lit(" a\n b "))).otherwise(""), element("author", element("name", F.col("source"))), element("author", element("name", F.col("lang"))),
        F.lit('<category term="c.'), "lang", F.lit('"/>'), F.when(F.col("doc_id") % 5 == 0, F.lit("<x:doi xmlns:x='y'>10/x</x:doi>")).otherwise(""), F.lit("</entry>"),
    )
    feeds = documents(spark, sf_dir).groupBy(F.floor(F.col("doc_id") / 40).alias("feed")).agg(F.concat(F.lit("<feed xmlns='http://www.w3.org/2005/Atom'><title>all</title>"), F.array_join(F.collect_list(entry), ""), F.lit("</feed>")).alias("xml"))
    return readers.atom_entries(feeds).select("arxiv_id", "title", "abstract", F.array_join("authors", ",").alias("authors"), F.array_join("categories", ",").alias("categories"), "doi")


@query("SELECT 'h' || (page_id % 7)::VARCHAR AS base, 'http://s/' || page_id::VARCHAR AS url FROM pages")
def sitemap_urls(spark, sf_dir):
    """Half of the bases have a sitemap, the others an index of two."""
    base, part = F.concat(F.lit("h"), (F.col("page_id") % 7).cast("string")), (F.col("page_id") % 2).cast("string")
    loc = F.concat(F.lit("<url><loc> http://s/"), F.col("page_id").cast("string"), F.lit(" </loc></url>"))
    whole = lambda c: F.concat(F.lit("<urlset xmlns='x'>"), F.array_join(F.collect_list(c), ""), F.lit("</urlset>")).alias("xml")
    listed = pages(spark, sf_dir).select(base.alias("base"), part.alias("part"), loc.alias("loc"), (F.col("page_id") % 7).alias("n"))
    plain = listed.where("n % 2 = 0").groupBy("base").agg(whole(F.col("loc")))
    inner = listed.where("n % 2 = 1").groupBy("base", "part").agg(whole(F.col("loc"))).select("base", F.concat_ws("/", F.lit("http:/"), "base", "part").alias("url"), "xml")
    index = inner.groupBy("base").agg(F.concat(F.lit("<sitemapindex>"), F.array_join(F.collect_list(F.concat(F.lit("<sitemap><loc>"), "url", F.lit("</loc></sitemap>"))), ""), F.lit("</sitemapindex>")).alias("xml"))
    return readers.sitemap_urls(plain.unionByName(index), inner.select("url", "xml"))


@query(f"WITH k AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents WHERE {sql_n_words('text')} >= 30) SELECT doc_id AS ord, md5('r/d:train:' || n::VARCHAR) AS doc_id, 'hf://r/d/train#' || n::VARCHAR AS url FROM k")
def dataset_documents(spark, sf_dir):
    return readers.dataset_documents(documents(spark, sf_dir), "r/d", "train", order="doc_id").select("ord", "doc_id", "url")


@query("SELECT source, tag, count(*) AS n FROM (SELECT source, 'g' AS tag FROM documents UNION ALL SELECT 'extra', 'g' FROM pages) GROUP BY source, tag")
def group_files(spark, sf_dir):
    """Files of a group put together: sources that rows have stand, and all rows are tagged."""
    extra = pages(spark, sf_dir).select(F.col("page_id").alias("doc_id"))
    both = readers.union_sources({"files": documents(spark, sf_dir).select("doc_id", "source"), "extra": extra}, overwrite=False)
    tagged = readers.tag_group(both.withColumn("meta", F.create_map(F.lit("dataset_group"), F.lit("old"))), "g")
    return tagged.groupBy("source", F.col("meta")["dataset_group"].alias("tag")).agg(F.count("*").alias("n"))


# --- frontier and guards

@query("SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def unseen_requests(spark, sf_dir):
    crawled = pages(spark, sf_dir)
    return crawl.unseen(crawled.select("url"), crawled.where("page_id % 3 = 0").select("url").distinct())


@query("WITH o AS (SELECT url, min(page_id) AS ord FROM pages WHERE page_id % 2 = 0 GROUP BY url) SELECT url, ord, 0 AS added FROM o UNION ALL SELECT url, min(page_id), 1 FROM pages WHERE url NOT IN (SELECT url FROM o) GROUP BY url")
def seed_upsert(spark, sf_dir):
    crawled = pages(spark, sf_dir)
    old = crawled.where("page_id % 2 = 0").groupBy("url").agg(F.min("page_id").alias("ord"))
    return frontier.upsert_seeds(old, crawled.select("url", F.col("page_id").alias("ord"))).withColumnRenamed("_new", "added")


# --- text functions

#: Letters beyond ASCII as x and all else beyond it as a blank, after which ASCII word boundaries are Unicode's.
PLAIN = "regexp_replace(regexp_replace(text, '[^\\x00-\\x7F\\p{L}\\p{N}\\p{M}]', ' ', 'g'), '[^\\x00-\\x7F]', 'x', 'g')"


@query("SELECT doc_id, " + sql_case([(f"len(regexp_extract_all({PLAIN}, {sql_text(p)}, 0, {sql_text('i' if i else 'c')})) / greatest({sql_n_words('text')}, 1) >= {least}", sql_text(t)) for p, i, t, least in V.TEXT_TYPES], "'unknown'") + " AS content_type FROM documents")
def classify_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", X.classify_text(F.col("text")).alias("content_type"))


@query(f"SELECT page_id, {chosen('lower(regexp_extract(url, ' + sql_text('([a-z]+)$') + ', 1))', V.LANGUAGE_WEIGHTS, str(V.LANGUAGE_WEIGHTS['unknown']))}::DOUBLE AS weight FROM pages")
def language_weights(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", S.language_weight(F.lower(F.regexp_extract("url", "([a-z]+)$", 1))).alias("weight"))


@query("SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '([\\p{L}\\p{N}_])-\\n([\\p{L}\\p{N}_])', '\\1\\2', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')) AS key FROM (SELECT doc_id, replace(regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g'), '. ', '-' || chr(10)) AS text FROM documents)")
def repaired_texts(spark, sf_dir):
    broken = F.replace(F.regexp_replace("text", r"[^\x00-\x7F]", "x"), F.lit(". "), F.lit("-\n"))
    return documents(spark, sf_dir).select("doc_id", F.sha2(readers.repair_hyphens(broken), 256).alias("key"))


@query(Q.CLEANED + "SELECT doc_id, CASE WHEN action = 'dropped' THEN 'flagged' ELSE action END AS action, action IN ('kept', 'dropped') AS kept FROM a")
def clean_flagged(spark, sf_dir):
    """Refused texts are kept and flagged."""
    config = CleanConfig(action="flag", threshold=Q.SAMPLE.threshold, groups=Q.SAMPLE_GROUPS, instant=Q.SAMPLE_INSTANT, html=False)
    return clean(documents(spark, sf_dir), config, order="doc_id").select("doc_id", "action", "kept")


# --- sinks, shards, schedules

@query("SELECT event_type, count(*) * 2 AS n FROM events GROUP BY event_type")
def event_append(spark, sf_dir):
    path = new_path(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    for _ in range(2):
        sinks.append_events(events, path)
    return spark.read.schema(events.schema).json(path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT doc_id::VARCHAR AS line FROM documents WHERE doc_id % 4 <> 0")
def log_lines(spark, sf_dir):
    path = new_path(spark, "log")
    documents(spark, sf_dir).select(F.when(F.col("doc_id") % 4 != 0, F.col("doc_id").cast("string")).otherwise("").alias("value")).write.text(path)
    return readers.log_lines(spark, path).select("line")


@query("SELECT doc_id::VARCHAR AS line FROM documents ORDER BY doc_id DESC LIMIT 150")
def log_tail(spark, sf_dir):
    """The last 150 lines of a log: the size is the report's feature."""
    path = new_path(spark, "log")
    documents(spark, sf_dir).select("doc_id").coalesce(1).sortWithinPartitions("doc_id").select(F.col("doc_id").cast("string").alias("value")).write.text(path)
    return readers.log_lines(spark, path, 150).select("line")


@query("SELECT 'lang=' || lang AS folder, sum(length(doc_id::VARCHAR) + 1)::BIGINT AS bytes FROM documents GROUP BY lang")
def file_tree(spark, sf_dir):
    path = new_path(spark, "tree")
    documents(spark, sf_dir).select("lang", F.col("doc_id").cast("string").alias("value")).write.partitionBy("lang").text(path)
    found = readers.file_tree(spark, path).where(F.length("sha256") == 64)
    folder = F.element_at(F.split("path", "/"), -2)
    return found.where(folder.startswith("lang=")).groupBy(folder.alias("folder")).agg(F.sum("size").cast("long").alias("bytes"))


@query(Q.OFFSETS + f", e AS (SELECT *, unnest(range(first_shard, last_shard + 1)) AS shard FROM s) SELECT 'shard_' || lpad(shard::VARCHAR, 5, '0') || '_train.bin' AS file, sum(least(n_tokens, (shard + 1) * {Q.SHARD} - token_offset) - greatest(0, shard * {Q.SHARD} - token_offset))::BIGINT AS n_tokens, true AS valid FROM e GROUP BY shard")
def shard_files(spark, sf_dir):
    """Shards written as binary files and read back."""
    folder = new_path(spark, "shards")
    sinks.write_shards(shards.pack_texts(documents(spark, sf_dir), ["doc_id"], shard_size=Q.SHARD), folder, "train")
    valid = sinks.valid_shards(spark, folder, "train")
    return readers.binary_shards(spark, folder).select("file", F.size("tokens").cast("long").alias("n_tokens"), F.lit(valid).alias("valid"))


@query(f"WITH e AS (SELECT doc_id, unnest(range(0, 3))::INT AS epoch FROM documents) SELECT doc_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY {Q.sql_uniform('42', 'epoch', 'doc_id')}, doc_id)::INT AS place FROM e")
def shuffled_epochs(spark, sf_dir):
    """Places are running totals in two levels, less those of the epochs before."""
    turns = shards.shuffled_epochs(documents(spark, sf_dir).select("doc_id"), ["doc_id"], 3)
    placed = running_total(turns.withColumn("_one", F.lit(1)), ["epoch", "turn", "doc_id"], "_one", "_before")
    first = placed.groupBy("epoch").agg(F.min("_before").alias("_first"))  # a row for each epoch
    return placed.join(F.broadcast(first), "epoch").select("doc_id", "epoch", (F.col("_before") - F.col("_first") + 1).cast("int").alias("place"))


@query("SELECT event_id, round(CASE WHEN event_id < 200 THEN 3e-4 * event_id / 200 WHEN event_id > 900 THEN 3e-5 ELSE 3e-5 + 0.5 * (3e-4 - 3e-5) * (1 + cos(pi() * (event_id - 200) / 700)) END, 10) AS rate FROM events")
def learning_rates(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(reports.cosine_lr(F.col("event_id"), 200, 900, 3e-4, 3e-5), 10).alias("rate"))


@query("SELECT p_partkey, (2 * 32000 * w + l * (2 * w * w + 2 * (w // 12 * kv) * w + 3 * w * i + 2 * w) + w)::BIGINT AS n_parameters FROM (SELECT p_partkey, 12 * (1 + p_partkey % 64) AS w, 1 + p_size AS l, 1 + p_partkey % 12 AS kv, 100 + p_partkey % 900 AS i FROM part)")
def parameter_counts(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    models = part.select("p_partkey", F.lit(32000).cast("long").alias("vocabulary"), (F.col("p_size") + 1).cast("long").alias("layers"), F.lit(12).cast("long").alias("heads"), (F.col("p_partkey") % 12 + 1).alias("kv_heads"), ((F.col("p_partkey") % 64 + 1) * 12).alias("width"), (F.col("p_partkey") % 900 + 100).alias("inner"))
    return reports.parameter_count(models).select("p_partkey", "n_parameters")


# --- sessions

@query("SELECT (n_nationkey + 1)::BIGINT AS dataset_id, CASE WHEN n_nationkey % 3 = 0 THEN 'complete' ELSE 'pending' END AS crawl, CASE WHEN n_nationkey % 4 = 1 THEN 'running' ELSE 'pending' END AS clean FROM nation")
def session_refresh(spark, sf_dir):
    groups = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_nationkey").cast("string").alias("group_id"), F.col("n_name").alias("name"))
    made = sessions.seed(sessions.empty(spark), groups)
    number = F.col("dataset_id") - 1
    done = sessions.refresh(made, made.where(number % 3 == 0).select("dataset_id", F.lit("crawl").alias("stage")))
    out = sessions.update(done, made.where(number % 4 == 1).select("dataset_id", F.lit("clean").alias("stage"), F.lit("running").alias("status")))
    return out.select("dataset_id", F.col("stages")["crawl"].alias("crawl"), F.col("stages")["clean"].alias("clean"))


@query("SELECT c_custkey, coalesce(r_name, 'own') AS config FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey < 3")
def group_configs(spark, sf_dir):
    region = table(spark, sf_dir, "region").where("r_regionkey < 3")
    groups = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("group_id"), F.col("r_name").alias("config"))
    return reports.group_configs(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("group_id"), F.lit("own").alias("config")), groups).select("c_custkey", "config")
