import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_model as L

DOCS = "doc_id bigint, text string, score double"


def vocabulary(words, short=40):
    ranked = words.most_common()
    endings = {}
    for w, c in ranked[L.SHORT - 1 :]:
        n, v = endings.get(w[-2:], (0, 0))
        endings[w[-2:]] = (n + c, v + 1)
    return L.Vocabulary([(L.END, 5), *ranked], endings, sum(words.values()) + 5, len(words) + 1)


def words_of(seed=1, n=3000):
    r = random.Random(seed)
    return Counter({"".join(r.choice("abcdef") for _ in range(r.randint(2, 7))).encode(): r.randint(1, 50) for _ in range(n)})


def test_gradients():
    v = vocabulary(words_of())
    net = L.Network(v)
    net.flat = net.flat.astype(np.float64)
    net._name()
    r = np.random.default_rng(2)
    inputs, targets = r.integers(0, L.SHORT + L.TAIL, (6, 3)), r.integers(0, L.SHORT + L.TAIL, (6, 3))
    fresh = r.random((6, 3)) < 0.2
    h = r.standard_normal((3, net.hidden))
    grad = L.Network(v, np.zeros_like(net.flat))
    net.window(h, inputs, targets, fresh, grad)
    used = np.flatnonzero(np.abs(grad.flat) > 1e-3)
    for i in r.choice(used, 40, replace=False):
        kept = net.flat[i]
        values = []
        for d in (1e-5, -1e-5):
            net.flat[i] = kept + d
            values.append(net.window(h, inputs, targets, fresh, L.Network(v, np.zeros_like(net.flat)))[0])
        net.flat[i] = kept
        assert abs((values[0] - values[1]) / 2e-5 - grad.flat[i]) < 2e-3 * max(1, abs(grad.flat[i]))


def test_probabilities_add_up_to_one():
    v = vocabulary(words_of())
    net = L.Network(v)
    h = np.random.default_rng(1).standard_normal((1, net.hidden)).astype(np.float32)
    every = np.arange(L.SHORT + L.TAIL)
    found, _ = net.log_probabilities(np.repeat(h, len(every), 0), every)
    assert abs(np.exp(found.astype(float)).sum() - 1) < 1e-4


def test_lockstep_equals_one_by_one():
    v = vocabulary(words_of())
    net = L.Network(v)
    r = np.random.default_rng(4)
    documents = [r.integers(0, L.SHORT + L.TAIL, n) for n in (1, 2, 31, 32, 33, 100, 7)]
    together = net.score(v, documents)
    for d, found in zip(documents, together, strict=True):
        h, last, total = np.zeros((1, net.hidden), np.float32), v.start, 0.0
        for x in d:
            h = net.step(h, net.embed[[last]])[0]
            total += float(net.log_probabilities(h, np.array([x]))[0][0])
            last = x
        assert abs(total - found) < 1e-2


@pytest.mark.parametrize("top", [20, 1200, L.TOP])
def test_base_equals_brute_force(spark, top):
    r = random.Random(3)
    words = ["the", "The", "é", "Éa", "a.b", "x\x85y"] + [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(r.choices(words[: r.randint(3, 46)], k=r.randint(0, 40)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "the the"), (7, rows[7][1]), (502, "never seen before the")]
    docs = spark.createDataFrame([(d, t, 0.0) for d, t in rows], DOCS).repartition(3)
    training = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(True))
    got = L.language_model_scores(docs, training, rounds=1, top=top).collect()
    taught = Counter()
    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 5 != 1:
            taught.update(L.tokens_of(t.encode() if t else None))
    n, v = sum(taught.values()), len(taught)
    want = Counter()
    for d, t in rows:
        tokens = L.tokens_of(t.encode() if t else None)
        base = sum(math.log10((taught[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        want[d, len(tokens), sum(taught[w] > 0 for w in tokens), n, round(base, 6)] += 1
    assert Counter((x.doc_id, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6)) for x in got) == want
    assert all(math.isfinite(x.score) and x.score < 0 for x in got)


def test_learns_order(spark):
    r = random.Random(5)
    rows = [(i, " ".join("abcdefgh"[(k + s) % 8] for k in range(r.randint(10, 60)))) for i, s in enumerate(r.choices(range(8), k=900))]
    docs = spark.createDataFrame([(d, t, 0.0) for d, t in rows], DOCS).coalesce(2)
    got = L.language_model_scores(docs, F.col("doc_id") % 5 != 1, group_tokens=20_000)
    x = got.agg(F.sum("base_score"), F.sum("score")).first()
    assert x[1] > 0.75 * x[0]


def test_every_document_is_learnt_once(spark, monkeypatch):
    rows = [(i, "a copy" if i % 3 == 0 else f"text {i}", 0.0) for i in range(900)] + [(None, None, 0.0), (None, "", 0.0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    held = spark.sparkContext.broadcast(v := L.vocabulary_of(L.written(L.count_tokens(docs), "counts")))
    seen = []

    def learn(held, start, rate):
        def run(batches):
            for batch in batches:
                for g, ids in zip(batch.column("group").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                    yield L.pa.RecordBatch.from_arrays([L.pa.array([ids + bytes([g])]), L.pa.array([0])], names=["w", "n"])

        return run

    monkeypatch.setattr(L, "_learn", learn)
    plain = L.written
    monkeypatch.setattr(L, "written", lambda df, name: (seen.append([bytes(x.w) for x in df.collect()]), plain(df.limit(0), name))[1])
    L.train(L.encode(docs, F.lit(True), held).where("token IS NULL"), v, held, group_tokens=100)
    assert len(seen) == L.ROUNDS and sum(map(len, seen)) == len(rows)
    copy = v.encode([b"a", b"copy", L.END])[0].astype("<u2").tobytes()
    dealt = [Counter(w[-1] for w in r if w[:-1] == copy) for r in seen]
    assert all(sum(c.values()) > 100 and max(c.values()) < 80 and len(c) > 4 for c in dealt)  # copies are dealt out


def slow_score(v, net, counts, tokens):
    """log10 probability of the tokens, one at a time, from the definitions."""
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    k, total, types = net.hidden, sum(counts.values()), len(counts)
    short = {w: i for i, w in enumerate(v.words[: v.n_short])}
    tail = lambda w: v.ending.get(w[-2:], L.TAIL - 1)
    members = {}
    for w, c in counts.items():
        if w not in short:
            members.setdefault(tail(w), []).append(c)
    h, last, out = [0.0] * k, L.SHORT + L.TAIL, 0.0
    for w in tokens:
        x = net.embed[last].astype(float)
        g = [sum(h[i] * float(net.loop[i, j]) for i in range(k)) for j in range(3 * k)]
        z, r = ([sigmoid(x[o + j] + g[o + j]) for j in range(k)] for o in (0, k))
        n = [math.tanh(x[2 * k + j] + r[j] * g[2 * k + j]) for j in range(k)]
        h = [(1 - z[j]) * n[j] + z[j] * h[j] for j in range(k)]
        last = short[w] if w in short else L.SHORT + tail(w)
        cls = last // L.PER_CLASS if w in short else net.n_ranks + tail(w)
        logits = np.array(h) @ net.classes.astype(float) + net.class_bias
        out += logits[cls] - np.log(np.exp(logits).sum())
        if w in short:
            logits = np.array(h) @ net.words[cls].astype(float) + net.word_bias[cls]
            out += logits[last % L.PER_CLASS] - np.log(np.exp(logits).sum())
        else:
            own = members.get(tail(w), [])
            out += math.log((counts.get(w, 0) + 0.5) / (sum(own) + 0.5 * (len(own) + 1)))
    assert total and types
    return out / math.log(10)


@pytest.mark.parametrize("top", [30, L.TOP])
def test_score_equals_brute_force(spark, monkeypatch, top):
    monkeypatch.setattr(L, "SHORT", 64)  # so that most words are outside the softmax
    monkeypatch.setattr(L, "PER_CLASS", 8)
    r = random.Random(8)
    words = [f"{a}{b}" for a in "pqrs" for b in range(60)]
    rows = [(i, " ".join(r.choices(words, weights=[1 / (1 + k) for k in range(len(words))], k=r.randint(0, 60)))) for i in range(60)]
    rows += [(100, None), (101, "unseen p1 unseen"), (None, "q5 q5"), (5, rows[5][1]), (102, " ".join(r.choices(words, k=3000)))]
    docs = spark.createDataFrame([(d, t, 0.0) for d, t in rows], DOCS).repartition(3)
    training = F.coalesce(F.col("doc_id") < 100, F.lit(True))
    kept = {}

    def train(encoded, v, *_):
        kept["v"] = v
        kept["flat"] = (0.3 * np.random.default_rng(1).standard_normal(L.Network(v).flat.size)).astype(np.float32)
        return kept["flat"]

    monkeypatch.setattr(L, "train", train)
    # The module's sizes are read where tasks run, so tasks run here.
    held = lambda x: type("Held", (), {"value": x})()
    counts = Counter(w for d, t in rows if d is None or d < 100 for w in L.tokens_of(t.encode() if t else None))
    ends = {}
    ranked = sorted((w for w in counts if w != L.END), key=lambda w: (-counts[w], w))[: top - 1]
    for w in counts:
        if w != L.END and w not in ranked[: 64 - 1]:
            n, k = ends.get(w[-2:], (0, 0))
            ends[w[-2:]] = (n + counts[w], k + 1)
    v = L.Vocabulary([(L.END, counts[L.END]), *((w, counts[w]) for w in ranked)], ends, sum(counts.values()), len(counts))
    net = L.Network(v, train(None, v))
    batch = L.pa.RecordBatch.from_pydict({"row": list(range(len(rows))), "doc_id": [d for d, _ in rows], "place": [0] * len(rows), "taught": [True] * len(rows), "text": [t for _, t in rows]})
    encoded = L.pa.Table.from_batches(list(L._encode(held(v))([batch])))
    whole = encoded.filter(L.pa.compute.is_null(encoded.column("token")))
    rare = encoded.filter(L.pa.compute.is_valid(encoded.column("token"))).to_pylist()
    scored = L.pa.Table.from_batches(list(L._score(held(v), held(net.flat))(whole.select([*L._KEPT, "ids"]).to_batches()))).to_pylist()
    assert len(scored) == len(rows) and docs.where(training).count() == 62
    for x in scored:
        extra = sum(math.log10(counts.get(y["token"], 0) + 0.5) for y in rare if y["row"] == x["row"])
        text = rows[x["row"]][1]
        want = slow_score(v, net, counts, L.tokens_of(text.encode() if text else None))
        assert abs(x["modelled"] + x["tail"] + extra - want) < 1e-3 * max(1, abs(want)), text
    assert rare or top == L.TOP


def test_joined_score_and_partitions(spark):
    """The query's score is the sum of its parts, whatever the partitions; a very long text is learnt and scored whole."""
    r = random.Random(6)
    words = [f"{a}{b}" for a in "pqrs" for b in range(700)]
    rows = [(i, " ".join(r.choices(words, weights=[1 / (1 + k) for k in range(len(words))], k=r.randint(0, 90))), 0.0) for i in range(300)] + [(900, " ".join(r.choices(words, k=60_000)), 0.0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = [L.language_model_scores(docs.repartition(k), F.col("doc_id") % 5 != 1, top=600, group_tokens=4_000).collect() for k in (1, 5)]
    a, b = ({x.doc_id: x for x in g} for g in got)
    assert len(a) == len(rows) and a[900].n_tokens == 60_001
    for k, x in a.items():
        assert abs(x.score - b[k].score) < 1e-4 * abs(x.score) and x.n_known == b[k].n_known


def test_empty(spark):
    assert L.language_model_scores(spark.createDataFrame([], DOCS), F.lit(True)).collect() == []


def test_split_equals_words():
    """Slices of texts are split at once: the words, their order and their texts are those of tokens_of."""
    r = random.Random(9)
    texts = ["".join(r.choice(["a", "B", "é", "ß", "x\x85y", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x00"]) for _ in range(r.randint(0, 30))).encode() for _ in range(300)]
    texts = [None, b"", b" ", *texts, b"\x1f\x20\x21", None]
    for some in (texts, texts[:1], [], [b"one"], [b"  "]):
        words, number, owner = L.split(some)
        listed = words.to_pylist()
        got = [[] for _ in some]
        for k, o in zip(number.tolist(), owner.tolist(), strict=True):
            got[o].append(listed[k])
        assert got == [L.tokens_of(x)[:-1] for x in some] and len(set(listed)) == len(listed)
    batch = L.pa.RecordBatch.from_arrays([L.pa.array(texts, L.pa.binary())], names=["text"])
    counted = {x["token"]: x["c"] for b in L._count([batch, batch]) for x in b.to_pylist()}
    assert counted == Counter(w for x in 2 * texts for w in L.tokens_of(x))


def test_states_wait_for_the_softmax(monkeypatch):
    """Scores of few documents in lockstep are made from many states at once, in blocks; there was a call for every 16 steps."""
    v = vocabulary(words_of())
    net = L.Network(v)
    r = np.random.default_rng(7)
    documents = [r.integers(0, L.SHORT + L.TAIL, n).astype("<u2") for n in (900, 40, 700, 0, 3)]
    calls, plain = [], net.log_probabilities
    monkeypatch.setattr(net, "log_probabilities", lambda h, x: (calls.append(len(x)), plain(h, x))[1])
    want = net.score(v, documents)
    assert calls == [1643]
    for block, span in ((7, 520), (512, 600), (1 << 12, 1 << 12)):
        monkeypatch.setattr(L, "BLOCK", block)
        monkeypatch.setattr(L, "SPAN", span)
        net.room, calls[:] = None, []
        assert np.allclose(net.score(v, documents), want, rtol=1e-5) and sum(calls) == 1643 and max(calls) <= span
    assert L.Network(v).score(v, []).tolist() == []
