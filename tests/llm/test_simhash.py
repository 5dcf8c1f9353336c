import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash as S

DOCS = "doc_id bigint, text string, lang string, fp string"


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """The smallest index reachable from each over at most two differing bits."""
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, f in enumerate(fps):
        for j, g in enumerate(fps[:i]):
            if (f ^ g).bit_count() <= 2:
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [root(i) for i in range(len(fps))]


def slow_names(rows):
    """For each (doc_id, fp) the smallest doc_id of its component."""
    component = slow_components([f for _, f in rows])
    return [min((d for (d, _), c in zip(rows, component, strict=True) if c == own and d is not None), default=None) for own in component]


@pytest.mark.parametrize("text", [None, "", "  \t", "a", "A b", "a b c", "x y z x y z x y z", "é b c d É", "w " * 70_000])
def test_fingerprint(text):
    assert S.fingerprint(text.encode() if text else None) & (1 << 64) - 1 == slow_fingerprint(text)


def clustered(seed):
    r = random.Random(seed)
    out = {0, 2**64 - 1}
    for _ in range(r.randint(1, 30)):
        base = r.getrandbits(64)
        out |= {base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(r.randint(1, 60))}
    return sorted(out | {r.getrandbits(64) for _ in range(50)})


@pytest.mark.parametrize("seed", range(12))
def test_trie_links(seed):
    fps = clustered(seed)
    counts = Counter()
    assert S.trie_links(np.array(fps, dtype=np.uint64), counts=counts).tolist() == slow_components(fps)
    assert counts["pruned"] > len(fps) and counts["visited"] < len(fps) ** 2 + 2 * len(fps)


def test_trie_is_pruned():
    r = random.Random(3)
    counts = Counter()
    S.trie_links(np.array(sorted({r.getrandbits(64) for _ in range(20_000)}), dtype=np.uint64), counts=counts)
    assert counts["pruned"] > 100_000  # node pairs over the budget, each with all pairs below it
    assert counts["visited"] < 20_000**2 / 40


@pytest.mark.parametrize("fps", [[], [5], [0, 2**64 - 1], [0, 1, 2, 3]])
def test_small_tries(fps):
    assert S.trie_links(np.array(fps, dtype=np.uint64)).tolist() == slow_components(fps)


@pytest.mark.parametrize("most", [1, 7, 1 << 16])
def test_links_over_subtries(spark, most):
    fps = clustered(1)
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint").repartition(3)
    label = {f: f for f in fps}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in S.links(reps, most=most).collect():
        a, b = a & (1 << 64) - 1, b & (1 << 64) - 1
        assert a != b
        x, y = sorted((root(a), root(b)))
        label[y] = x
    want = slow_components(fps)
    assert [root(f) for f in fps] == [fps[i] for i in want]


def named(spark, monkeypatch, rows):
    """near_duplicates' groups of rows with given fingerprints."""
    docs = spark.createDataFrame([(d, f - (1 << 64) if f >> 63 else f) for d, f in rows], "doc_id bigint, fp bigint")
    monkeypatch.setattr(S, "fingerprints", lambda docs, *_: docs)
    return sorted(((x.doc_id, x.fp & (1 << 64) - 1, x.component_id) for x in S.near_duplicates(docs).collect()), key=str)


def test_null_ids_link_like_any_other(spark, monkeypatch):
    rows = [(1, 0), (None, 0x10001), (2, 0x1000100010001), (None, 0x10001), (9, 1 << 40), (None, (1 << 63) | 0xFF00FF00), (None, (1 << 63) | 0xFF00FF01), (7, 0x7777 << 30)]
    want = sorted(((d, f, c) for (d, f), c in zip(rows, slow_names(rows), strict=True)), key=str)
    assert (None, 0x10001, 1) in want and (2, 0x1000100010001, 1) in want
    assert named(spark, monkeypatch, rows) == want


def test_random_groups_with_null_ids(spark, monkeypatch):
    r = random.Random(11)
    rows = [(None if r.random() < 0.3 else r.randrange(400), f) for f in clustered(4) for _ in range(r.randint(1, 2))]
    want = sorted(((d, f, c) for (d, f), c in zip(rows, slow_names(rows), strict=True)), key=str)
    assert named(spark, monkeypatch, rows) == want


def test_groups_equal_brute_force(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(None, "null id", "en", "x"), (7, "twice", "en", "x"), (7, "twice", "en", "x"), (1000, None, None, None), (1001, "", "en", "x"), (1002, "one", "en", "x"), (1003, "long word " * 30_000, "en", "x")]
    for i in range(60):
        base = [r.choice(words) for _ in range(300)]
        for j in range(5):
            copy = list(base)
            for _ in range(j):
                copy[r.randrange(300)] = r.choice(words)
            rows.append((None if j == 1 else 2000 + 10 * i + j, " ".join(copy), "en", "x"))
    want = [(d, slow_fingerprint(t)) for d, t, *_ in rows]
    want = sorted(((d, f, c) for (d, f), c in zip(want, slow_names(want), strict=True)), key=str)
    got = S.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((x.doc_id, x.fp & (1 << 64) - 1, x.component_id) for x in got), key=str) == want


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("budget", [0, 1, 3, 5])
def test_other_budgets(budget):
    fps = clustered(2)
    label = S.trie_links(np.array(fps, dtype=np.uint64), budget=budget)
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= budget]
    assert all(label[i] == label[j] for i, j in near)
    assert len(set(label.tolist())) == len(fps) - len(set(np.flatnonzero(label != np.arange(len(fps)))))


def test_hex():
    assert S.fingerprint(b"") == 0
