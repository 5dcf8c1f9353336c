import random

import pytest

from tessera.operators import dedup
from tessera.operators import components as components_module
from tessera.operators.components import components
from tessera.streaming import stateful
from tessera.tables import new_path, written


def texts(seed, n):
    """Texts in families of near copies, of which some are exact, and texts that share a passage only."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    families = [[word() for _ in range(r.randint(5, 60))] for _ in range(n // 8)]
    passage = [word() for _ in range(20)]
    out = []
    for i in range(n):
        words = list(r.choice(families))
        for _ in range(r.choice([0, 0, 1, 2])):
            words[r.randrange(len(words))] = word()
        if r.random() < 0.2:
            words = words[:5] + passage
        out.append((i, " ".join(words) if r.random() < 0.97 else r.choice([None, "", "one", "one two"])))
    return out


def brute(rows, threshold, n=3):
    import re

    sets = {}
    for i, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset((x,) for x in w)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and len(a & b) / len(a | b) >= threshold - 1e-12:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, find(i)) for i in ids)


@pytest.mark.parametrize(("seed", "threshold"), [(1, 0.8), (2, 0.55)])
def test_clusters_equal_brute_force(spark, seed, threshold):
    rows = texts(seed, 250)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, rep string")
    want = brute(rows, threshold)
    assert len({c for _, c in want}) < 230 and sorted(map(tuple, dedup.jaccard_clusters(docs, threshold).collect())) == want


def test_copies_make_few_links(spark):
    """A group of 3,000 different near copies: a few links each and one component, where all pairs would be 4.5 million."""
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*words, f"own{i}"])) for i in range(3000)]
    _, sets = dedup.token_sets(spark.createDataFrame(rows, "doc_id bigint, text string"))
    sets = written(sets, "sets")
    links = dedup.jaccard_links(written(dedup.heads(sets, dedup.frequent_shingles(sets), 0.92), "heads"), sets, 0.92)
    assert links.count() < 9_000
    assert components(links).select("component").distinct().count() == 1 and components(links).count() == 3000


def test_any_order_of_rarity_finds_all(spark):
    rows = texts(5, 150)
    _, sets = dedup.token_sets(spark.createDataFrame(rows, "doc_id bigint, text string"))
    sets = written(sets, "sets")
    order = dedup.frequent_shingles(sets)
    found = [sorted(map(tuple, components(dedup.jaccard_links(written(dedup.heads(sets, o, 0.7), "heads"), sets, 0.7)).collect())) for o in (order, order[:0], order[::-1])]
    assert found[0] == found[1] == found[2] and found[0]


@pytest.mark.parametrize("batches", [1, 6])
def test_batches_of_a_stream_come_to_the_same_clusters(spark, batches):
    rows = texts(7, 160)
    index = stateful.NearCopyIndex(spark, new_path(spark, "index"), 0.7)
    r = random.Random(batches)
    of = [r.randrange(batches) for _ in rows]
    for b in range(batches):
        batch = spark.createDataFrame([x for x, k in zip(rows, of, strict=True) if k == b], "doc_id bigint, text string")
        index.add(batch, b)
        if b % 3 == 0:  # tried again, after its commit
            index.add(batch, b)
    assert sorted(map(tuple, index.clusters().collect())) == brute(rows, 0.7)


def test_a_batch_that_failed_is_tried_again(spark, monkeypatch):
    """Tables that a failed attempt left don't count."""
    rows = texts(8, 60)
    index = stateful.NearCopyIndex(spark, new_path(spark, "index"), 0.7)
    first, second = (spark.createDataFrame(rows[k::2], "doc_id bigint, text string") for k in (0, 1))
    index.add(first, 0)
    with monkeypatch.context() as m:
        m.setattr(stateful, "write_json", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            index.add(second, 1)
    assert index.table("members").count() == 30
    index.add(second, 1)
    assert sorted(map(tuple, index.clusters().collect())) == brute(rows, 0.7)


def test_empty_batches(spark):
    index = stateful.NearCopyIndex(spark, new_path(spark, "index"))
    index.add(spark.createDataFrame([], "doc_id bigint, text string"), 0)
    index.add(spark.createDataFrame([(1, None), (2, "a b c d")], "doc_id bigint, text string"), 1)
    assert sorted(map(tuple, index.clusters().collect())) == [(1, 1), (2, 2)]


def test_words_of_a_task_are_those_of_the_pattern(spark, monkeypatch):
    """Words are cut in tasks as tokens() cuts them, on characters of all kinds, and sets are equal if and only if those of their grams are."""
    r = random.Random(3)
    odd = "a b\u00e9_\u0301 \u200d-\u00b2\u00bd\u203f \U0001d54f\U0001f600\n\u4e2d\u6587\u0130\u00df.\u24b6\u0e01\u0e31 7\u0663,\x00"
    rows = [(i, "".join(r.choice(odd) for _ in range(r.randint(0, 40)))) for i in range(300)]
    rows += [(300 + i, "".join(chr(c) for c in range(start, start + 400) if not 0xD800 <= c < 0xE000)) for i, start in enumerate(range(0, 0x20000, 400))]
    rows += [(2000, "w" * 5000), (2001, "w" * 5001), (2002, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(dedup, "BLOCK", 7)
    monkeypatch.setattr(dedup, "TOGETHER", 50)
    of = {x.doc_id: x.w for x in docs.select("doc_id", dedup.tokens(dedup.F.col("text")).alias("w")).collect()}
    grams = {i: frozenset(tuple(w[k : k + 3]) for k in range(len(w) - 2)) if len(w) >= 3 else frozenset((x,) for x in w) for i, w in of.items() if w}
    members, sets = dedup.token_sets(docs)
    got = {x.id: x.key for x in members.collect()}
    assert got.keys() == grams.keys()
    assert len(set(got.values())) == len(set(grams.values())) == len({(got[i], grams[i]) for i in got})
    assert all(len(x.set) == len(grams[x.rep]) for x in sets.collect())


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_few_edges_take_one_round(spark, monkeypatch, few):
    """Components of a long chain in random order, a star, loops and repeated edges, solved at once or in rounds."""
    monkeypatch.setattr(components_module, "FEW", few)
    r = random.Random(4)
    chain = r.sample(range(1000), 60)
    edges = [*zip(chain, chain[1:], strict=False), *((2000, 2000 + k) for k in range(1, 40)), (7000, 7000), (2001, 2000), (2001, 2000)]
    made = []
    kept = components_module.written
    monkeypatch.setattr(components_module, "written", lambda df, name: made.append(name) or kept(df, name))
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: min(chain) for x in chain} | {2000 + k: 2000 for k in range(40)}
    assert len(made) == 2 if few else len(made) > 2


def test_no_set_is_stored(spark, monkeypatch):
    """Sets are made again where they are compared, only those of pairs that sketches don't rule out, and each once for a task of many pairs."""
    r = random.Random(6)
    word = lambda: f"w{r.randrange(10**6)}"
    passage = [word() for _ in range(40)]
    base = [word() for _ in range(300)]
    rows = [(i, " ".join(passage + [word() for _ in range(200)])) for i in range(40)]  # share rare shingles, but aren't similar
    rows += [(100 + i, " ".join([*base, f"own{i}"])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made, kept = {}, dedup.written

    def written_(df, name, *more):
        out = kept(df, name, *more)
        made.setdefault(name, []).append((out.columns, out.count()))
        return out

    monkeypatch.setattr(dedup, "written", written_)
    monkeypatch.setattr(dedup, "MEMBERS", 8)
    found = {(x.a, x.b) for x in dedup.jaccard_pairs_of(docs).collect()}
    assert found == {(100 + i, 100 + j) for i in range(30) for j in range(i + 1, 30)}
    assert not any("set" in columns for tables in made.values() for columns, _ in tables)
    assert [n for _, n in made["taking"]] == [30]


def test_sketches_rule_out_no_similar_pair(spark):
    import numpy as np

    r = np.random.default_rng(7)
    sets, pairs = [], []
    for k in range(300):
        own = r.integers(-(2**63), 2**63, int(r.integers(1, 3000)), np.int64)
        other = own.copy()
        other[: int(r.integers(0, max(1, len(own) // 8)))] += 1
        sets += [np.unique(own), np.unique(other[: len(other) - int(r.integers(0, max(1, len(own) // 20)))])]
        pairs.append((2 * k, 2 * k + 1))
    table = spark.createDataFrame([(k, len(x), dedup._sketch(x)) for k, x in enumerate(sets)], "rep bigint, n int, sketch binary")
    left = {(x.a, x.b) for x in dedup._may_be_similar(spark.createDataFrame(pairs, "a bigint, b bigint"), table, 0.92).collect()}
    similar = {(a, b) for a, b in pairs if len(np.intersect1d(sets[a], sets[b])) / len(np.union1d(sets[a], sets[b])) >= 0.92}
    assert similar <= left and len(similar) > 50 and len(left) < 290


def test_the_index_keeps_texts_and_no_sets(spark):
    """What a batch adds is no larger than a few times its compressed text, where sets take 8 bytes a shingle."""
    import os

    r = random.Random(9)
    rows = [(i, " ".join(f"w{r.randrange(50)}" for _ in range(2000))) for i in range(40)]
    folder = new_path(spark, "index")
    index = stateful.NearCopyIndex(spark, folder)
    index.add(spark.createDataFrame(rows, "doc_id bigint, text string"), 0)
    size = sum(os.path.getsize(f"{d}/{x}") for d, _, names in os.walk(folder.removeprefix("file://")) for x in names if x.endswith(".parquet"))
    assert size < 5 * 40 * 2000


def test_clusters_store_no_set(spark, monkeypatch):
    made, kept = [], dedup.written
    monkeypatch.setattr(dedup, "written", lambda df, name, *more: made.append(df.columns) or kept(df, name, *more))
    rows = texts(10, 40)
    assert sorted(map(tuple, dedup.jaccard_clusters(spark.createDataFrame(rows, "doc_id bigint, text string"), 0.7).collect())) == brute(rows, 0.7)
    assert made and not any("set" in columns for columns in made)
