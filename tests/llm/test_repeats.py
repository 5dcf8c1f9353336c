import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import repeats as R

DOCS = "doc_id bigint, text string, spans string"


def slow(rows, length):
    """Per (doc_id, text): kept bytes and spans, by a dictionary of all windows."""
    import zlib

    docs = sorted({(R.NULL_ID if d is None else d, zlib.crc32((t or "").encode()), (t or "").encode()) for d, t in rows})
    seen, out = set(), {}
    for d, _, b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out[d, b] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def rows_of(seed, n=120):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéñß") for _ in range(r.randint(1, 8)))
    passages = [" ".join(word() for _ in range(r.randint(10, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(1, 5)):
            k = r.random()
            if k < 0.4:
                p = r.choice(passages)
                a = r.randint(0, len(p) // 2)
                parts.append(p[a : r.randint(a, len(p))])
            elif k < 0.5:
                parts.append(word() * r.randint(1, 60))
            else:
                parts.append(" ".join(word() for _ in range(r.randint(1, 50))))
        rows.append((i, " ".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1]), (2, rows[2][1]), (2, rows[7][1] + " x"), (None, rows[9][1]), (None, rows[9][1]), (600, None), (601, ""), (602, "short"), (603, "a" * 400), (604, "b" + "a" * 99), (605, "ab" * 300)]
    return rows


@pytest.mark.parametrize("hot", [R.HOT, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, hot):
    rows = rows_of(seed)
    want = slow(rows, 100)
    docs = spark.createDataFrame([(d, t, "other") for d, t in rows], DOCS)
    got = R.remove_repeats(docs.drop("spans").repartition(5), hot=hot, kept="sha256").collect()
    assert len(got) == len(rows)
    by_size = {}
    for (d, b), v in want.items():
        by_size.setdefault((d, len(b)), set()).add(v)
    for x in got:
        d = R.NULL_ID if x.doc_id is None else x.doc_id
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept) in by_size[d, x.n_bytes], (x.doc_id, x)


@pytest.mark.parametrize("hot", [R.HOT, 3])
def test_index_alone_gives_the_same(spark, hot):
    """Without folding by hashes the index compares all bytes, and removes the same."""
    docs = spark.createDataFrame([(d, t, "") for d, t in rows_of(3)], DOCS).drop("spans").repartition(5)
    folded, alone = (sorted(map(tuple, R.remove_repeats(docs, hot=hot, kept="sha256", fold=f).collect()), key=str) for f in (True, False))
    assert folded == alone and any(x[2] for x in folded)


def test_repetitive_text_has_few_runs():
    r = random.Random(1)
    passage = bytes(r.choice(b"abcdefgh") for _ in range(500))
    contexts = [passage[a : a + 300] for a in range(0, 200, 2)]
    index = R.RunLengthIndex(contexts)
    assert len(index.head) == len(index.runs) < index.n / 20


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics(seed):
    r = random.Random(seed)
    contexts = ["".join(r.choice("ab") for _ in range(r.randint(1, 40))).encode() for _ in range(r.randint(1, 12))]
    contexts += [r.choice(contexts) for _ in range(3)]
    index = R.RunLengthIndex(contexts)
    text, ends = [], []
    for k, c in enumerate(contexts):
        text += [(1, b) for b in c] + [(0, k)]
        ends.append(len(text))
    order = sorted(range(len(text)), key=lambda i: text[i:])
    want, above = [0] * len(text), [-1] * len(text)
    for a, b in zip(order, order[1:], strict=False):
        n = 0
        while text[a + n] == text[b + n] and text[a + n][0]:
            n += 1
        want[b], above[b] = n, a
    for block in (7, 1 << 16):
        found = list(index.matching_statistics(block))
        assert [x for _, _, c in found for x in c.tolist()] == want
        assert [x for _, a, _ in found for x in a.tolist()] == above
    # The runs are the transform.
    transform = [text[i - 1] if i else (0, -1) for i in order]
    runs = [k for k in range(len(text)) if not k or transform[k] != transform[k - 1]]
    assert index.run_starts.tolist() == runs
    assert index.runs.tolist() == [transform[k][1] + 1 if transform[k][0] else 0 for k in runs]
    keys = np.arange(len(text))
    least = index.earliest(keys, 5)
    for i in range(len(text)):
        w = text[i : i + 5]
        if len(w) == 5 and all(x[0] for x in w):
            assert least[i] == min(j for j in range(len(text)) if text[j : j + 5] == w)


def test_anchors_in_parts(monkeypatch):
    r = np.random.default_rng(1)
    data = r.integers(97, 100, 9000).astype(np.uint8)
    edges = np.array([0, 50, 50, 3000, 3090, 3200, 9000])
    whole = R.anchors(data, edges, 100, 32)
    monkeypatch.setattr(R, "PART_BYTES", 700)
    parts = R.anchors(data, edges, 100, 32)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


def test_extra_columns_and_empty(spark):
    text = "é" * 300
    docs = spark.createDataFrame([(1, text, "as it is"), (2, "é" * 100, "second")], DOCS).withColumnRenamed("spans", "note")
    one, two = R.remove_repeats(docs).orderBy("doc_id").collect()
    assert (one.note, one.n_removed, one.kept) == ("as it is", 598, "é")
    assert (two.note, two.n_removed, two.kept) == ("second", 200, "")
    assert bytes(R.remove_repeats(docs, kept="bytes").orderBy("doc_id").first().kept) == "é".encode()
    assert R.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_tags_are_the_same_everywhere(spark):
    texts = ["", "a", "é" * 40, "long text " * 5000] + [f"text {i}" for i in range(200)]
    rows = spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string").select("text", *R.document_key()).collect()
    assert all(x.doc == R.NULL_ID and x.tag == R.tag_of(x.text.encode()) for x in rows) and len({x.tag for x in rows}) == len(texts)


@pytest.mark.parametrize("times", [2, 3])
def test_suffix_order_and_its_sorts(monkeypatch, times):
    """Contexts of up to 168 bytes take four sorts where three ranks fit into 64 bits."""
    r = random.Random(times)
    contexts = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 168))) for _ in range(40)] + [b"ab" * 84] * 3
    index, sorts, sort = R.RunLengthIndex(contexts), [], np.argsort
    want = sorted(range(index.n), key=lambda k: ((*index.text[k : k + index.room[k]].tolist(), 0), k))
    assert index._suffixes(169).tolist() == want
    monkeypatch.setattr(np, "argsort", lambda *a, **more: sorts.append(1) or sort(*a, **more))
    index._suffixes(169)
    assert len(sorts) == 4
    if times == 2:  # as for a context of millions of bytes
        class Large(int):
            def __pow__(self, k):
                return 1 << 63

            def __add__(self, k):
                return Large(int(self) + k)

        index.n = Large(index.n)
        assert index._suffixes(169).tolist() == want and len(sorts) == 10


def test_spans_of_a_batch_are_cut_at_once():
    r, texts, spans = random.Random(5), [], []
    for k in range(300):
        n = r.choice([0, 0, 1, 5, 40])
        texts.append(bytes(r.randrange(256) for _ in range(n)))
        own = [sorted(r.sample(range(n + 1), 2)) for _ in range(r.choice([0, 1, 6]))] if n else []
        spans.append(None if not own and k % 2 else [{"lo": a, "hi": b} for a, b in own])
    array = pa.array([[{"lo": 0, "hi": 9}], *spans], pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))[1:]
    left, removed, runs = R.without(texts, array)
    for text, own, x, n, k in zip(texts, spans, left, removed, runs, strict=True):
        gone = {i for s in own or () for i in range(s["lo"], s["hi"])}
        assert x == bytes(b for i, b in enumerate(text) if i not in gone) and n == len(gone)
        edges = {i for s in own or () for i in range(2 * s["lo"], 2 * s["hi"] + 1)}  # touching spans are one run
        assert k == sum(i - 1 not in edges for i in edges)
    assert R.without([], array[:0])[0] == []
