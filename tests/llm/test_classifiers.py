import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality as Q
from tessera.llm import toxicity as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double"


def corpus(n=600, seed=1):
    r = random.Random(seed)
    plain = [f"word{i}" for i in range(80)]
    rows, toxic, quality = [], [], []
    for i in range(n):
        parts = [" ".join(r.choices(plain, k=r.randint(4, 15))) for _ in range(r.randint(2, 8))]
        bad = r.random() < 0.3
        if bad:
            parts[r.randrange(len(parts))] += " " + r.choice(["vilest", "Nastyish", "nastyings"])
        junk = r.random() < 0.3
        text = ". ".join(parts) + "."
        if junk:
            text = text.upper() + "!!" * 20
        rows.append((i, text, r.choice(["en", "fr", None]), f"src{i % 5}", len(text), 9.0))
        toxic.append((i, int(bad)))
        quality.append((i, int(not junk)))
    return rows, toxic, quality


EDGES = [(9000, None, None, None, None, 0.0), (9001, "", "en", "x", 0, 0.0), (None, "null id", "en", "x", -5, 0.0), (9002, "long " * 60_000, "en", "x", 300_000, 0.0)]


def test_toxicity_held_out_and_location(spark):
    rows, toxic, _ = corpus()
    docs = spark.createDataFrame(rows + EDGES + [rows[3]], DOCS)
    labels = spark.createDataFrame([(i, y, "x") for i, y in toxic if i % 4] + [(7777, 1, "x"), (5, None, "x"), (None, 1, "x")], "doc_id bigint, toxic int, score string")
    model = T.train(docs, labels)
    truth = dict(toxic)
    scores = [(x.doc_id, x.score) for x in T.score(docs, model).collect()]
    assert len(scores) == len(rows) + len(EDGES) + 1 and all(0 <= s <= 1 for _, s in scores)
    held = [(truth[i], s) for i, s in scores if i is not None and i in truth and i % 4 == 0]
    assert sum((s >= T.THRESHOLD) == y for y, s in held) >= 0.97 * len(held)
    assert all(s < T.THRESHOLD for i, s in scores if i in (9000, 9001, 9002))
    found = T.locate(docs, model).collect()
    assert found and all(any(w in x.words for w in ("vilest", "nasty")) for x in found)


def test_toxicity_gradient():
    r = random.Random(3)
    rows = [(("bad word. " if y else "") .encode() + b" ".join(r.choices([b"a", b"b", b"c"], k=9)), y) for y in r.choices((0, 1), k=200)]
    few, many = T.fit(rows, 5), T.fit(rows, 300)
    loss = lambda m: -sum(math.log(max(1e-9, m.score(t) if y else 1 - m.score(t))) for t, y in rows)
    assert loss(many) < loss(few) / 2


def slow_toxicity(model, text):
    """The noisy-or from its definition, a character at a time."""
    clean, sentence = 1 - model.leak, []

    def close():
        nonlocal clean
        if sentence:
            clean *= 1 - 1 / (1 + math.exp(-(model.bias + sum(sum(model.weights.get(f, 0.0) for f in {word, *(word[:k] + b"*" for k in (5, 6, 7) if len(word) > k)}) for word in sentence))))
            sentence.clear()

    word = b""
    for c in (text or "").encode():
        b = bytes([c]).lower()
        if b in (b".", b"!", b"?", b"\n", b"\r"):
            if word:
                sentence.append(word)
            word = b""
            close()
        elif c < 128 and not b.isalnum() and c >= 0x20 and c != 0x7F or b in b"\t\x0b\x0c":
            if word:
                sentence.append(word)
            word = b""
        else:
            word += b
    if word:
        sentence.append(word)
    close()
    return 1 - clean


def test_toxicity_equals_brute_force(spark):
    rows, toxic, _ = corpus(200)
    texts = [(r[0], r[1]) for r in rows] + [(900, None), (901, ""), (None, "null. id vilest!"), (902, "a,b;vilest? \u00c9t\u00e9\tnastyings"), (903, "vilest words. " * 4000)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = T.train(docs, spark.createDataFrame(toxic, "doc_id bigint, toxic int"))
    assert model.weights
    for x in T.score(docs, model).join(docs.withColumnRenamed("doc_id", "d"), F.expr("doc_id <=> d")).collect():
        assert abs(x.score - slow_toxicity(model, x.text)) < 1e-9, x.text


def test_toxicity_gradient_by_differences():
    r = random.Random(9)
    bags = [[[r.randrange(6) for _ in range(r.randint(0, 4))] for _ in range(r.randint(0, 5))] for _ in range(60)]
    y = r.choices((0, 1), k=60)
    b, x = T.Bags(bags, y, 6), np.array([r.gauss(0, 1) for _ in range(8)])
    value, grad = b.likelihood(x)
    p = lambda z: 1 / (1 + math.exp(-z))
    want = 0.0
    for bag, label in zip(bags, y, strict=True):
        clean = 1 - p(x[-1])
        for s in bag:
            clean *= 1 - p(x[-2] + sum(x[f] for f in s))
        want += math.log(1 - clean) if label else math.log(clean)
    assert abs(value - want) < 1e-9
    for k in range(8):
        d = np.zeros(8)
        d[k] = 1e-6
        assert abs((b.likelihood(x + d)[0] - b.likelihood(x - d)[0]) / 2e-6 - grad[k]) < 1e-4


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    rows, toxic, _ = corpus(100)
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows + rows], "doc_id bigint, text string")
    seen = []
    monkeypatch.setattr(T, "fit", lambda rows: seen.append(rows))
    labels = spark.createDataFrame(toxic, "doc_id bigint, toxic int")
    T.train(docs, labels)
    assert len(seen[0]) == 100  # an id counts once
    T.train(docs, labels, most=30)
    assert len(seen[1]) == 30
    T.train(docs, labels, most_bytes=2000)
    assert 0 < sum(len(t) for t, _ in seen[2]) <= 2000


def test_a_text_over_the_bound_is_passed_over(spark):
    """One labelled text larger than all the bound, whose id hashes lowest: the others are learnt from."""
    rows, toxic, _ = corpus(100)
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame(toxic, "doc_id bigint, toxic int")
    first = docs.orderBy(F.xxhash64("doc_id")).first().doc_id
    huge = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("plain words. "), 100_000)).otherwise(F.col("text")))
    model = T.train(huge, labels, most_bytes=1_000_000)
    assert model.weights and any(w != 0 for w in model.weights.values())
    bad, good = ([r[1] for r in rows if dict(toxic)[r[0]] == k and r[0] != first and r[1]] for k in (1, 0))
    scores = [sorted(model.score(t.encode()) for t in texts) for texts in (bad, good)]
    assert scores[0][len(bad) // 4] > scores[1][-len(good) // 4]


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (2, 1)]])
def test_without_both_kinds(spark, labels):
    rows, _, _ = corpus(30)
    docs = spark.createDataFrame(rows, DOCS)
    t = T.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert 0 <= t.score(b"anything. at all") <= 1
    q = Q.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert Q.score(docs, q).count() == 30


def test_cotraining_held_out(spark):
    rows, _, quality = corpus()
    docs = spark.createDataFrame(rows + EDGES, DOCS)
    labels = spark.createDataFrame([(i, y) for i, y in quality if i % 3 == 1], "doc_id bigint, quality int")
    scored = Q.score(docs, Q.train(docs, labels))
    assert scored.columns.count("score") == 1
    truth = dict(quality)
    got = scored.collect()
    assert len(got) == len(rows) + len(EDGES)
    held = [(truth[x.doc_id], x.kept) for x in got if x.doc_id in truth and x.doc_id % 3 != 1]
    assert sum(y == k for y, k in held) >= 0.97 * len(held)
    assert all(0 <= x.content_score <= 1 and 0 <= x.metadata_score <= 1 for x in got)


def in_memory(content, meta):
    """A pool of rows in arrays, all of them looked at."""
    h = np.arange(len(content)) + 1

    def ask(model, taken, counts):
        parts = [[] for _ in range(6)]
        for view, odds in enumerate(model.views_of(content, meta)):
            p = 1 / (1 + np.exp(-odds))
            for label, certainty in ((0, 1 - p), (1, p)):
                rows = sorted((i for i in range(len(h)) if model.knows[view] and certainty[i] >= model.sure()[label] and h[i] not in taken[view]), key=lambda i: (-certainty[i], h[i]))[: counts[label]]
                for part, value in zip(parts, (h[rows], [view] * len(rows), [label] * len(rows), certainty[rows], content[rows], meta[rows]), strict=True):
                    part.append(value)
        return tuple(np.concatenate(x) for x in parts)

    return ask


def views(n, seed, known):
    """Rows whose label shows in the content, and in the language as far as known says."""
    r = np.random.default_rng(seed)
    y = (r.random(n) < 0.5).astype(int)
    content = r.random((n, Q.MEASURES))
    content[:, 0] = y + r.normal(0, 0.2, n)
    lang = np.where(r.random(n) < known, y, r.integers(0, 2, n))
    return content, np.stack([lang, r.integers(0, 5, n), r.integers(0, 5000, n)], 1), y


def test_views_teach_each_other():
    content, meta, y = views(3000, 1, 0.97)
    content[np.random.default_rng(5).random(3000) < 0.5, 0] = 0.5  # half of the texts say nothing
    few = 300
    alone, taught = (Q.fit(content[:few], meta[:few], y[:few], in_memory(content[few:], meta[few:]), rounds) for rounds in (0, 4))
    right = lambda m: ((m.odds(content[few:], meta[few:])[2] > 0) == y[few:]).mean()
    assert right(taught) > 0.97 and right(taught) >= right(alone)
    assert len(taught.report) == 5 and all(sum(x["content gave"]) and sum(x["metadata gave"]) for x in taught.report[:4])


def test_ignorant_view_moves_nothing():
    content, meta, y = views(2000, 2, 0.0)
    model = Q.fit(content[:1000], meta[:1000], y[:1000], in_memory(content[1000:], meta[1000:]))
    _, b, _ = model.odds(content, meta)
    assert abs(b - model.prior).max() < 1.5
    assert all(sum(x["metadata gave"]) == 0 for x in model.report[:4])


def test_pool_over_a_table(spark):
    """The surest rows of a table in many partitions are those of the whole."""
    content, meta, y = views(1500, 3, 0.9)
    model = Q.fit(content[:400], meta[:400], y[:400])
    rows = [(i + 1, c.tolist(), m.tolist()) for i, (c, m) in enumerate(zip(content, meta, strict=True))]
    table = spark.createDataFrame(rows, "h bigint, content array<double>, meta array<bigint>").repartition(7)
    taken = (np.arange(1, 300), np.arange(200, 600))
    for x, z in zip(Q.pool_of(table)(model, taken, (7, 40)), in_memory(content, meta)(model, taken, (7, 40)), strict=True):
        assert np.allclose(x, z)


def test_exchange_on_the_tables(spark):
    """Both views hand over pseudo-labels on the given tables, and what they teach changes scores."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    training = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    alone, taught = (Q.train(docs, training, rounds=r) for r in (0, 4))
    assert sum(sum(x["content gave"]) for x in taught.report[:4]) > 400
    assert sum(sum(x["metadata gave"]) for x in taught.report[:4]) > 0
    a, b = ({x.doc_id: x for x in Q.score(docs.limit(500), m).collect()} for m in (alone, taught))
    assert sum(abs(a[i].metadata_score - b[i].metadata_score) > 1e-6 for i in a) > 250
    assert sum(abs(a[i].content_score - b[i].content_score) > 1e-6 for i in a) > 250


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id bigint, toxic int, quality int")
    assert T.score(docs, T.train(docs, labels)).collect() == []
    assert Q.score(docs, Q.train(docs, labels)).collect() == []


def slow_measures(text):
    """The content view from its definitions, a character at a time."""
    text = (text or "").encode()
    words, word = [], b""
    for c in text + b" ":
        if c in b" \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = b""
        else:
            word += bytes([c])
    if not words:
        return [0.0] * Q.MEASURES
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, size = len(words), len(text)
    share = lambda test: sum(map(test, text)) / size
    sign = lambda c: 0x21 <= c <= 0x7E and not chr(c).isalnum() and chr(c) not in ".,;:\'\"-()?"
    ends = sum(c in b".!?" for c in text)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        math.log(1 + n), share(lambda c: 65 <= c <= 90), share(lambda c: 48 <= c <= 57), share(sign), len(set(words)) / n, same / n,
        1 - len(set(lines)) / len(lines), size / n, math.log(1 + n / len(lines)), ends / n, text.count(b"!") / n,
    ]


def test_quality_scores_equal_brute_force(spark):
    """Scores of whole texts from the model's weights, bins and calibration, one row at a time."""
    rows, _, quality = corpus(300)
    docs = spark.createDataFrame(rows + EDGES, DOCS)
    model = Q.train(docs, spark.createDataFrame(quality, "doc_id bigint, quality int"))
    sigmoid = lambda x: 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))
    truth = {}
    for i, text, lang, source, size, _ in rows + EDGES:
        m = slow_measures(text)
        assert np.allclose(m, Q.measures(text.encode() if text is not None else None))
        a, b = model.views
        first = a.w[-1] + sum(a.w[k * (Q.BINS + 1) + sum(e < x for e in model.edges[k])] for k, x in enumerate(m))
        lang, source, size = Q.metadata(lang, source, size)
        fine = Q.SIZES + 1 if size < 0 else sum(e < size for e in model.sizes)
        coarse = Q.COARSE if size < 0 else min(fine * Q.COARSE // (Q.SIZES + 1), Q.COARSE - 1)
        cells = (lang, source, fine, (31 * lang + coarse) % Q.BUCKETS, (31 * source + coarse) % Q.BUCKETS, (31 * lang + source) % Q.BUCKETS)
        second = b.w[-1] + sum(b.w[k * Q.BUCKETS + c] for k, c in enumerate(cells))
        odds = [v.slope * x + v.shift for v, x in ((a, first), (b, second))]
        both = model.prior + sum(w * (o - model.prior) for w, o in zip(model.weights, odds, strict=True))
        truth[i] = [sigmoid(x) for x in (*odds, both)]
    for x in Q.score(docs, model).collect():
        want = truth[x.doc_id]
        assert np.allclose((x.content_score, x.metadata_score, x.score), want, atol=1e-9) and x.kept == (want[2] >= Q.KEEP)
