import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import dedup, frontier, gate, html, reports, shards, weighting
from tessera.operators.clean import CleanConfig, clean, redact, refusal_hits
from tessera.operators.components import components
from tessera.plans import sessions, stages
from tessera.schema import as_documents
from tessera.sources import config, crawl, readers, sinks
from tessera.streaming import stateful


def test_clean_order_and_actions(spark):
    long = "plain words without any refusal at all in them " * 3
    refused = "I cannot help with that. I must refuse. " * 3
    rows = [(1, refused), (2, refused), (3, long), (4, long), (5, "short"), (6, "As an AI model, " + long), (7, None), (8, "<p>" + long.upper() + "</p>"), (9, "x" * 200)]
    docs = spark.createDataFrame(rows, "ord bigint, text string")
    done = {r.ord: r.action for r in clean(docs, CleanConfig(max_length=190)).collect()}
    assert done == {1: "dropped", 2: "duplicate", 3: "kept", 4: "duplicate", 5: "too_short", 6: "dropped", 7: "too_short", 8: "kept", 9: "too_long"}
    flagged = {r.ord: (r.action, r.kept) for r in clean(docs, CleanConfig(action="flag", dedup=False)).collect()}
    assert flagged[1] == ("flagged", True) and flagged[2] == ("flagged", True)


@pytest.mark.parametrize(("text", "want"), [("abcd", "[REMOVED]d"), ("xabcabcx", "x[REMOVED][REMOVED]x"), ("none", "none"), (None, None)])
def test_redact_merges_overlaps(spark, text, want):
    hits = refusal_hits(CleanConfig(groups={"g": (1.0, ("ab", "bc"))}, instant=()))
    df = spark.createDataFrame([(text,)], "t string").select(redact(F.col("t"), hits(F.col("t"))))
    assert df.first()[0] == want


def test_gate_equals_simulation(spark):
    r = random.Random(1)
    rows = [(f"d{i % 7}", i, r.random() * (0.4 if i % 7 < 4 else 1)) for i in range(900)]
    scores, shut, want = {}, set(), {}
    for d, o, s in rows:
        want[o] = d not in shut
        scores.setdefault(d, []).append(s)
        last = scores[d][-20:]
        if len(scores[d]) >= 10 and sum(last) / len(last) < 0.35:
            shut.add(d)
    df = spark.createDataFrame(rows, "domain string, ord bigint, score double").repartition(5)
    gated = gate.signal_gate(df)
    assert {x.ord: x.admitted for x in gated.collect()} == want
    assert {x.domain for x in gate.abandoned(gated).collect()} == shut
    assert gate.domain_cap(df, 3).count() == 21


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (10, 11), (11, 12), (12, 13), (13, 14), (14, 15), (20, 20), (5, None)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, **{i: 10 for i in range(10, 16)}}


def test_jaccard_pairs_equal_brute_force(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(80):
        if rows and r.random() < 0.6:
            t = r.choice(rows)[1].split()
            if t:
                t[r.randrange(len(t))] = r.choice(vocabulary)
        else:
            t = r.choices(vocabulary, k=r.randint(0, 60))
        rows.append((i, " ".join(t)))

    def grams(t):
        w = t.split()
        return frozenset(tuple(w[k : k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset(w)

    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    reps = {}
    for i, t in rows:
        if grams(t):
            reps.setdefault(grams(t), i)
    items = sorted((i, g) for g, i in reps.items())
    want = {(a, b) for k, (a, ga) in enumerate(items) for b, gb in items[k + 1 :] if len(ga & gb) / len(ga | gb) >= 0.8}
    _, sets = dedup.token_sets(docs)
    assert {(x.a, x.b) for x in dedup.jaccard_pairs(sets.select("rep", "set"), 0.8).collect()} == want


def test_greedy_vectors(spark):
    rows = [(0, [1.0, 0.0], 1.0), (1, [1.0, 0.01], 2.0), (2, [0.0, 1.0], 1.0), (3, [0.01, 1.0], 1.0), (4, [-1.0, 0.0], 1.0)]
    df = spark.createDataFrame(rows, "ord bigint, embedding array<float>, weight double")
    assert sorted(x.ord for x in dedup.greedy_vector_dedup(df).collect()) == [1, 2, 4]


def test_reweight_conserves(spark):
    df = spark.createDataFrame([(i, float(i % 5) * 0.5) for i in range(2000)] + [(5000, None), (5001, float("nan")), (5002, -1.0)], "doc_id bigint, final_weight double")
    out = weighting.reweight(df)
    total = sum(float(i % 5) * 0.5 for i in range(2000))
    assert abs(out.count() - total) < 100
    assert out.where("doc_id >= 5000").count() == 0
    assert {(x.doc_id, x.copy_no) for x in out.collect()} == {(x.doc_id, x.copy_no) for x in weighting.reweight(df.repartition(7)).collect()}
    with pytest.raises(ValueError, match="unknown strategy"):
        weighting.reweight(df, strategy="none")


@pytest.mark.parametrize("n", [1, 2, 400])
def test_split(spark, n):
    rows = weighting.train_val_split(spark.range(n).withColumnRenamed("id", "doc_id")).collect()
    held = sum(x.split == "val" for x in rows)
    assert held == (max(1, int(n * 0.005)) if n > 1 else 1)
    assert sorted(x.position for x in rows) == list(range(n))


@pytest.mark.parametrize("size", [7, 100, 10_000])
def test_pack_conserves_tokens(spark, size):
    texts = ["", "a", "hello world", "é" * 40, "x" * 25]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").select("doc_id", shards.byte_tokens(F.col("text")).alias("tokens"))
    want = [t for x in texts for t in [*(b + 6 for b in x.encode()), 3]]
    packed = {}
    for p in shards.pack(docs, ["doc_id"], shard_size=size).collect():
        for k, t in enumerate(p.tokens):
            packed[p.shard, p.at + k] = t
    assert [packed[k] for k in sorted(packed)] == want
    assert all(at < size for _, at in packed)


@pytest.mark.parametrize(("n", "windows"), [(8, 0), (9, 0), (10, 1), (18, 2), (17, 1)])
def test_windows_leave_an_exact_fit_out(spark, n, windows):
    df = spark.createDataFrame([(0, list(range(n)))], "shard bigint, tokens array<int>")
    got = shards.train_windows(df, 8).collect()
    assert len(got) == windows
    assert all(w.x == list(range(w.start, w.start + 8)) and w.y == list(range(w.start + 1, w.start + 9)) for w in got)


def test_frontier(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("b", "b")], "src string, dst string")
    got = {x.url: x.depth for x in frontier.frontier(spark.createDataFrame([("a",)], "url string"), edges, 3).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_pages(spark):
    page = "<html><title> T </title><script>no</script><p>yes &amp; more</p><a href='/x'>l</a><a href='mailto:a@b'>m</a><a href='y#z'>k</a></html>"
    df = spark.createDataFrame([(1, "http://h.org/a/b", page), (2, "http://h.org/", None)], "page_id bigint, url string, html string")
    assert {x.link for x in html.links(df).collect()} == {"http://h.org/x", "http://h.org/y"}
    row = df.select(html.extract(F.col("html")).alias("x")).first().x
    assert row.title == "T" and "yes & more" in row.text and "no" not in row.text


def test_json_lines_and_artifacts(spark, tmp_path):
    good = tmp_path / "good"
    spark.createDataFrame([("1", "t", 7)], "doc_id string, text string, unknown int").write.json(str(good))
    row = readers.json_lines(spark, str(good)).first()
    assert (row.doc_id, row.language, row.final_weight) == ("1", "en", 1.0)
    bad = tmp_path / "bad.jsonl"
    bad.write_text('{"doc_id":"1","text":"a"}\n[1]\nnot json\n{"text":"no id"}\n')
    assert readers.json_lines(spark, str(bad), "DROPMALFORMED").count() <= 2
    with pytest.raises(Exception):  # noqa: B017
        readers.json_lines(spark, str(bad)).collect()
    path = str(tmp_path / "artifact")
    manifest = sinks.write_artifact(spark.range(10), path, "numbers", settings={"a": 1})
    assert manifest["rows"] == 10 and sinks.valid_artifact(spark, path, {"a": 1}) and not sinks.valid_artifact(spark, path, {"a": 2})
    with pytest.raises(ValueError, match="nothing to write"):
        sinks.write_artifact(spark.range(0), str(tmp_path / "none"), "numbers")


def test_stages_resume_and_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, str(i), f"document number {i} " * (10 + i % 9)) for i in range(40)] + [(100, "100", "document number 3 " * 13)], "ord bigint, doc_id string, text string")
    folder = str(tmp_path / "run")
    config = stages.RunConfig(shard_size=2_000)
    packed = stages.run(spark, docs, folder, config)
    again = stages.run(spark, docs, folder, config)
    assert packed.count() == again.count() > 0
    files = stages.export_shards(packed, str(tmp_path / "shards")).collect()
    read = readers.binary_shards(spark, str(tmp_path / "shards")).collect()
    assert {f.file: f.n_tokens for f in files} == {r.file: len(r.tokens) for r in read}
    with pytest.raises(ValueError, match="unknown stages"):
        stages.run(spark, docs, folder, config, stages=("nope",))


def test_sources(spark):
    papers = spark.createDataFrame([(1, "2401.1", "T", "abstract words " * 15, ["A", "B"], ["cs"], "2024-01-02T", "")], "ord bigint, arxiv_id string, title string, abstract string, authors array<string>, categories array<string>, published string, doi string")
    cites = spark.createDataFrame([("2401.1", 99)], "arxiv_id string, citations bigint")
    row = readers.paper_documents(papers, cites).first()
    assert row.citations == 99 and row.text.startswith("Title: T\nAuthors: A, B") and row.content_type == "research_paper" and row.meta["category"] == "research_paper"
    maps = spark.createDataFrame([("h", "<urlset xmlns='x'><url><loc> http://h/a </loc></url></urlset>")], "base string, xml string")
    assert readers.sitemap_urls(maps).first().url == "http://h/a"
    feed = "<feed xmlns='http://www.w3.org/2005/Atom'><entry><id>http://arxiv.org/abs/2401.1v2</id><title>A\n b</title><summary>s</summary><published>p</published><updated>u</updated></entry></feed>"
    entry = readers.atom_entries(spark.createDataFrame([(feed,)], "xml string")).first()
    assert (entry.arxiv_id, entry.title) == ("2401.1", "A b")
    files = spark.createDataFrame([(1, "a.py", 10, "blob", "word " * 12, 9), (2, "b.bin", 10, "blob", "word " * 12, 9), (3, "c.py", 10**7, "blob", "word " * 12, 9), (4, "d.md", 10, "tree", "word " * 12, 9)], "ord bigint, path string, size bigint, type string, text string, stars bigint")
    assert [x.url for x in readers.repository_files(files).collect()] == ["a.py"]
    assert as_documents(spark.range(1).withColumnRenamed("id", "ord")).first().source == ""


def test_reports(spark):
    rows = [(1, "train", "complete"), (1, "export", "complete"), (2, "train", "complete"), (3, "crawl", "running"), (4, "crawl", "complete")]
    states = reports.session_state(spark.createDataFrame(rows, "dataset_id bigint, stage string, status string"))
    assert {x.dataset_id: x.state for x in states.collect()} == {1: "COMPLETE", 2: "TRAINED", 3: "RUNNING", 4: "COLLECTED"}


def test_crawl_filters_and_source(spark):
    requests = spark.createDataFrame([("http://h/a/x",), ("http://h/a/b/y",), ("http://h",), ("http://i/a",)], "url string")
    rules = spark.createDataFrame([("h", "*", False, "/a"), ("h", "*", True, "/a/b"), ("h", "me", False, "/a/b"), ("h", "other", False, "/")], "host string, agent string, allow boolean, prefix string")
    assert {x.url for x in crawl.robots_allow(requests, rules).collect()} == {"http://h/a/b/y", "http://h", "http://i/a"}
    seen = spark.createDataFrame([("http://h",)], "url string")
    assert crawl.unseen(requests.unionByName(requests), seen).count() == 3
    spark.dataSource.register(crawl.page_source("tessera_pages", lambda u: (200, "text/html", f"<p>{u}</p>") if "x" in u else None, 2))
    pages = spark.read.format("tessera_pages").option("urls", "ax\nb\ncx\n").load()
    assert sorted(x.html for x in crawl.fetched_ok(pages).collect()) == ["<p>ax</p>", "<p>cx</p>"]


def test_config(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("general: {action: flag, score_threshold: 0.5}\nhtml: {enabled: false}\nrefusal_filter:\n  pattern_groups:\n    a: {enabled: true, weight: 2, patterns: [x]}\n    b: {enabled: false, patterns: [y]}\n  instant_drop_patterns: {enabled: false, patterns: [z]}\n")
    c = config.clean_config(config.load(str(path)))
    assert (c.action, c.threshold, c.html, c.groups, c.instant) == ("flag", 0.5, False, {"a": (2.0, ("x",))}, ())
    assert config.merged({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"c": 4}, "e": 5}) == {"a": {"b": 1, "c": 4}, "d": 3, "e": 5}
    assert config.run_config({"shard": {"shard_size": 7}}).shard_size == 7
    with pytest.raises(KeyError):
        config.select_group([{"id": "a"}], "b")


def test_sessions(spark, tmp_path):
    groups = spark.createDataFrame([(2, "g2", "second set"), (1, "g1", "a/b")], "ord int, group_id string, name string")
    first = sessions.seed(sessions.empty(spark), groups)
    again = sessions.seed(first, groups.unionByName(spark.createDataFrame([(3, "g3", "")], groups.schema)))
    assert [(x.dataset_id, x.group_id, x.name) for x in again.orderBy("dataset_id").collect()] == [(1, "g1", "ab"), (2, "g2", "second-set"), (3, "g3", "dataset")]
    done = sessions.refresh(again, spark.createDataFrame([(1, "export"), (2, "crawl")], "dataset_id bigint, stage string"))
    states = {x.dataset_id: x.state for x in reports.session_state(sessions.stage_rows(done)).collect()}
    assert states == {1: "COMPLETE", 2: "COLLECTED", 3: "COLLECTED"}
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "f.txt").write_text("x")
    row = sessions.ingest(spark, str(tmp_path), "local").first()
    assert row["size"] == 1 and len(row.sha256) == 64


def test_streams_equal_batches(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i % 60:02d}:00", f"t{i % 9}", float(i % 10) / 20) for i in range(300)]
    df = spark.createDataFrame(rows, "ord bigint, t string, text string, score double").selectExpr("ord", "t::timestamp_ntz AS ts", "text", "score")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))

    def drain(out, name):
        q = out.writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / f"c{name}")).trigger(availableNow=True).format("parquet").start(str(tmp_path / name))
        q.awaitTermination()
        return spark.read.schema(out.schema).parquet(str(tmp_path / name))

    assert drain(stateful.first_seen(stream, late="1 day"), "seen").count() == 9
    gated = {x.ord: x.admitted for x in drain(stateful.gate(stream.withColumn("domain", stream.text)), "gate").collect()}
    assert gated == {x.ord: x.admitted for x in gate.signal_gate(df.withColumnRenamed("text", "domain")).collect()}
    query = stateful.buffered_dedup(stream.select("ord", "text").withColumnRenamed("ord", "doc_id"), str(tmp_path / "near"), str(tmp_path / "cn")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "near")).count() == 9


def test_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n\nthree\n")
    (tmp_path / "b.log").write_text("x\n")
    assert sorted((x.file, x.line) for x in readers.log_lines(spark, str(tmp_path), 2).collect()) == [("a.log", "three"), ("a.log", "two"), ("b.log", "x")]
    (tmp_path / "seeds.txt").write_text("# note\n\n http://a \nhttp://b\n")
    assert [x.url for x in readers.text_list(spark, str(tmp_path / "seeds.txt")).collect()] == ["http://a", "http://b"]


def test_gate_over_ranges(spark):
    """One domain with most pages, many with few, over more ranges than some domains have pages."""
    import random

    from tessera.operators import gate

    r = random.Random(6)
    rows = [("hot", i, r.random() * (0.9 if i < 700 else 0.3)) for i in range(1000)] + [(f"d{k}", i, r.random()) for k in range(15) for i in range(r.randint(1, 40))]
    rows += [(None, i, r.random()) for i in range(50)]
    pages = spark.createDataFrame(rows, "domain string, ord bigint, score double").repartition(5)
    want = {}
    for domain in {d for d, _, _ in rows}:
        seen, shut = [], False
        for d, i, s in sorted((x for x in rows if x[0] == domain), key=lambda x: x[1]):
            was = shut
            seen.append(s)
            last = seen[-20:]
            shut = shut or (len(seen) >= 10 and sum(last) / len(last) < 0.35)
            want[d, i] = (len(seen), round(sum(last) / len(last), 9), not was)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "4", "97"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = {(x.domain, x.ord): (x.seq, round(x.rolling, 9), x.admitted) for x in gate.signal_gate(pages).collect()}
            assert got == want, parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
