import random

import corpus_pipeline as P
import pyarrow as pa
from tessera.llm import near_copies as N

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(rows):
    """Ids of the first document of each group."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((root(i), root(j)), key=lambda k: rows[k][0])
                label[y] = x
    return {rows[root(i)][0] for i in range(len(rows))}


def planted():
    r = random.Random(8)
    line = " ".join(f"common{k}" for k in range(30))
    rows = [(1, None), (2, ""), (3, "few words"), (4, "Few  words"), (5, line), (6, f"{line} more")]
    for g in range(25):
        base = [f"w{r.randrange(300)}" for _ in range(r.randint(40, 200))]
        for k in range(8):
            copy = list(base)
            for _ in range(k):  # one to seven words changed: similar to more or less than 0.8
                copy[r.randrange(len(copy))] = f"new{r.randrange(1000)}"
            rows.append((100 + 10 * g + k, " ".join(copy) + (f" {line}" if k % 2 else "")))
    r.shuffle(rows)
    return rows


def test_stage_equals_brute_force(spark, monkeypatch):
    rows = planted()
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).repartition(3)
    want = brute_force(rows)
    assert len(want) < len(rows) - 20
    assert sorted(x.doc_id for x in P.drop_near_copies(spark, docs, "").collect()) == sorted(want)
    monkeypatch.setattr(N, "frequent", lambda counted: (N.np.empty(0, N.np.uint64), N.np.empty(0, N.np.int64)))  # whatever the order
    assert sorted(x.doc_id for x in P.drop_near_copies(spark, docs, "").collect()) == sorted(want)


def test_sketch_never_overstates():
    r = random.Random(2)
    for _ in range(200):
        a = {r.getrandbits(64) for _ in range(r.randint(0, 400))}
        b = {x for x in a if r.random() < 0.9} | {r.getrandbits(64) for _ in range(r.randint(0, 50))}
        x, y = (N.np.array(sorted(v), dtype=N.np.uint64) for v in (a, b))
        assert int(N.np.bitwise_count(N.sketch(x) ^ N.sketch(y)).sum()) <= len(a ^ b)


def test_blocks_lose_no_link(spark, monkeypatch):
    """One large group of near copies whose shingles' members are cut into small blocks, without the rounds before."""
    rows = planted()
    base = [f"b{k}" for k in range(100)]
    r = random.Random(4)
    for i in range(60):
        copy = list(base)
        for _ in range(r.randint(1, 4)):
            copy[r.randrange(100)] = f"n{r.randrange(10_000)}"
        rows.append((5000 + i, " ".join(copy)))
    monkeypatch.setattr(N, "BLOCK", 5)
    monkeypatch.setattr(N, "ROUNDS", 0)
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).repartition(3)
    assert sorted(x.doc_id for x in P.drop_near_copies(spark, docs, "").collect()) == sorted(brute_force(rows))


def dense(m, n=40):
    """m sets of which any two are similar, in blocks of one shingle or of one class."""
    sets = [N.np.array([*range(n - 1), 1000 + k], N.np.uint64) << N.np.uint64(20) for k in range(m)]
    columns = {"s": [7] * m, "class": [1] * m, "x": [0] * m, "y": [0] * m, "key": list(range(m)), "n": [n] * m, "i": [0] * m, "c": list(range(m)), "block": [0] * m}
    return pa.RecordBatch.from_pydict({**columns, "bits": [N.sketch(x).view(N.np.int64) for x in sets], "own": [x.view(N.np.int64) for x in sets]})


def test_rows_grow_with_a_group_and_not_with_its_square():
    for solve in (N._across, N._within):
        for m in (1, 30, 120):
            batch = dense(m)
            found = [x for out in solve([batch.slice(0, m // 2), batch.slice(m // 2)]) for x in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)]
            assert len(found) == m - 1
            reached = {0}
            for _ in range(m):
                reached |= {x for pair in found if reached & set(pair) for x in pair}
            assert reached == set(range(m))


def test_classes_in_blocks_lose_no_link(spark, monkeypatch):
    """Near copies of which few are similar to any one, cut into small blocks by texts and by shingles."""
    base, r, rows = [f"b{k}" for k in range(60)], random.Random(9), planted()
    for i in range(50):
        copy = list(base)
        for k in r.sample(range(60), 2):
            copy[k] = f"n{r.randrange(4)}"
        rows.append((5000 + i, " ".join(copy)))
    want = sorted(brute_force(rows))
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).repartition(3)
    monkeypatch.setattr(N, "ROUNDS", 0)
    for texts, shingles_held in ((7, 4_000_000), (1024, 500)):
        monkeypatch.setattr(N, "CLASS_BLOCK", texts)
        monkeypatch.setattr(N, "CLASS_SHINGLES", shingles_held)
        assert sorted(x.doc_id for x in P.drop_near_copies(spark, docs, "").collect()) == want


def long_texts():
    """Texts of over 1,024 shingles: near copies, some of them shorter than the next power of two, and texts that share the half of another."""
    r, rows = random.Random(3), []
    for g in range(5):
        base = [f"g{g}w{k}" for k in range(r.randint(1300, 2300))]
        for k in range(6):
            copy = list(base)
            for _ in range(4 * k):
                copy[r.randrange(len(copy))] = f"n{r.randrange(10_000)}"
            rows.append((10_000 + 100 * g + k, " ".join(copy)))
        rows.append((10_000 + 100 * g + 50, " ".join(base[: int(len(base) * 0.87)])))
        rows += [(10_000 + 100 * g + 60 + k, " ".join([*base[: len(base) // 2], *(f"h{g}.{k}.{i}" for i in range(len(base) // 2))])) for k in range(6)]
    return [*rows, *planted()]


def test_long_texts_equal_brute_force(spark, monkeypatch):
    rows = long_texts()
    want = sorted(brute_force(rows))
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS).repartition(3)
    assert sorted(x.doc_id for x in P.drop_near_copies(spark, docs, "").collect()) == want
    monkeypatch.setattr(N, "ROUNDS", 0)
    monkeypatch.setattr(N, "SKETCH_WORDS", 100)
    assert sorted(x.doc_id for x in P.drop_near_copies(spark, docs, "").collect()) == want


def test_whole_sets_of_long_texts_that_share_a_half_stay_where_they_are(spark, monkeypatch):
    """A sketch of 1,024 bits rules out nothing for sets of thousands: they were all sent whole."""
    sent, before = [], N._dealt
    rows = [(i, " ".join([*(f"w{i // 2}.{k}" for k in range(1500)), *(f"own{i}.{k}" for k in range(1500))])) for i in range(20)]
    monkeypatch.setattr(N, "_dealt", lambda rows, by, blocks: sent.append(rows.count() if "own" in rows.columns else 0) or before(rows, by, blocks))
    found = N.near_copies(spark.createDataFrame(rows, "key bigint, text string")).collect()
    assert sum(sent) == 0 and len({x.group for x in found}) == 20


def test_half_a_sketch_is_its_halves(spark):
    r = random.Random(6)
    own = N.np.array(sorted(r.getrandbits(64) for _ in range(3000)), dtype=N.np.uint64)
    large = N.sketch(own, N.width(len(own)))
    assert len(large) == 64 and (large[:32] ^ large[32:] == N.sketch(own, 2048)).all() and N.width(1024) == 1024 and N.width(1025) == 2048
    other = N.sketch(own[:2000], 2048)
    row = spark.createDataFrame([(large.view(N.np.int64).tolist(), other.view(N.np.int64).tolist())], "a array<bigint>, b array<bigint>")
    want = int(N.np.bitwise_count(N.sketch(own, 2048) ^ other).sum())
    assert row.select(N._apart("a", "b"), N._apart("b", "a")).first() == (want, want)


def test_empty(spark):
    assert N.near_copies(spark.createDataFrame([], "key bigint, text string")).collect() == []
