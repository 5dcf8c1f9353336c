import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import queries as Q
from tessera.llm import spelling as S

DOCS = "doc_id bigint, text string, word string, n string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, shortest=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    return forms(counts)


def forms(counts):
    less = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            less[w[:i] + w[i + 1 :]].add(w)
    near = {}
    for w in counts:
        found = {v for i in range(len(w)) for v in less[w[:i] + w[i + 1 :]] if len(v) == len(w) and sum(a != b for a, b in zip(v, w, strict=True)) == 1}
        found |= less.get(w, set()) | {w[:i] + w[i + 1 :] for i in range(len(w)) if w[:i] + w[i + 1 :] in counts}
        near[w] = found
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed, n):
    r = random.Random(seed)
    base = ["".join(r.choice("abé") for _ in range(r.randint(4, 9))) for _ in range(40)] + ["aaaaa", "aaaaaa", "aaaaaaa", "aaabaaa", "ÿÿÿÿÿÿ", "×÷×÷×", "Straße", "STRASSE", "running"]

    def word():
        w = r.choice(base)
        if r.random() < 0.3:
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abcéÿ") + w[i:], w[:i] + r.choice("abcÀà") + w[i + 1 :]])
        return w

    rows = [(i, r.choice([" ", "-", "1"]).join(word() for _ in range(r.randint(0, 40)))) for i in range(n)]
    return [*rows, (None, "aaaaa aaaaa"), (n, None), (n + 1, ""), (3, rows[3][1]), (3, rows[3][1])]


def run(spark, rows, **more):
    return sorted((tuple(r) for r in S.variants(spark.createDataFrame([(i, t, "clash", "x") for i, t in rows], DOCS), **more).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])


@pytest.mark.parametrize(("seed", "per_group"), [(0, 20_000), (1, 7), (2, 40)])
def test_equals_brute_force(spark, monkeypatch, seed, per_group):
    monkeypatch.setattr(S, "ASKED", 16)
    rows = corpus(seed, 150)
    want = brute(rows)
    assert len(want) > 60 and sum(w[2] != w[0] for w in want) > 10 and run(spark, rows, per_group=per_group) == want


def test_chains_are_followed_to_the_last(spark):
    """Each word's form is the next one, twice as frequent; a chain of seven."""
    chain = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcdwzyx", "abcvwzyx", "abuvwzyx"]
    rows = [(i * 1000 + k, w) for k, w in enumerate(chain) for i in range(3 * 2**k)]
    got = run(spark, rows)
    assert got == brute(rows)


def test_tree_reports_rectangles():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 500):
        values = r.permutation(n)
        tree = S.WaveletTree(values)
        lo, least = r.integers(0, n + 1, 200), r.integers(0, n + 1, 200)
        hi, end = np.minimum(n, lo + r.integers(0, n + 1, 200)), np.minimum(n, least + r.integers(0, n + 1, 200))
        number, found = tree.report(lo, hi, least, end)
        got = defaultdict(set)
        for k, v in zip(number.tolist(), found.tolist(), strict=True):
            assert v not in got[k]
            got[k].add(v)
        for k in range(200):
            assert got[k] == {v for v in values[lo[k] : hi[k]].tolist() if least[k] <= v < end[k]}


def test_every_pair_is_found_once():
    r = random.Random(4)
    for length in (5, 6, 9):
        words = sorted({"".join(r.choice("ab") for _ in range(k)) for k in (length, length - 1) for _ in range(60)})
        grid = S.Grid([w.encode() for w in words], length)
        pairs = Counter((words[a], words[b]) for p in range(4) for x, y in grid.near(range(S.part_edges(length)[p], S.part_edges(length)[p + 1])) for a, b in zip(x.tolist(), y.tolist(), strict=True))
        want = set()
        for b in (w for w in words if len(w) == length):
            want |= {(a, b) for a in words if len(a) == length and sum(x != y for x, y in zip(a, b, strict=True)) == 1}
            want |= {(a, b) for a in words if len(a) < length and any(b[:i] + b[i + 1 :] == a for i in range(length))}
        assert set(pairs) == want and set(pairs.values()) == {1}


def test_near_pairs_meet_in_one_group(spark):
    words = spark.createDataFrame([("colour", 9), ("color", 30), ("colouz", 3), ("bolour", 3)], "word string, n bigint")
    groups = defaultdict(set)
    for x in S.group_rows(words, per_group=1).collect():
        groups[x.length, x.part, x.salt].add(x.word)
    assert any({"colour", "color"} <= g for g in groups.values()) and any({"colour", "colouz"} <= g for g in groups.values())


def test_very_long_words(spark):
    r = random.Random(2)
    long = "".join(r.choice("abcdefgh") for _ in range(20_000))
    rows = [(i, t) for i, t in enumerate([long] * 6 + [long[:700] + "é" + long[701:]] * 3 + [long[:-1]] * 3)]
    got = run(spark, rows)
    assert [(len(w), n, near, len(root)) for w, _, root, n, near, _ in sorted(got, key=lambda x: -x[3])] == [(len(x[0]), x[3], x[4], len(x[2])) for x in sorted(forms({x[0]: x[3] for x in got}), key=lambda x: -x[3])]


def test_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(None, None), (1, "short a b c")]) == []


def test_query_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted((tuple(r) for r in Q.op13_wavelet_variants(spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])
    assert got == brute([(d.doc_id, d.text) for d in docs])
