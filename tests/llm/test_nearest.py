import math
import random

import numpy as np

from tessera.llm import nearest as N

SCHEMA = "vec_id bigint, embedding array<float>, list int"


def brute(rows, k, asked):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v and len(v) == 16 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, x in good:
        if q in asked:
            scores = sorted((-(x @ y) / math.sqrt((x @ x) * (y @ y)), i) for i, y in good if i != q)
            out[q] = [(i, -s) for s, i in scores[:k]]
    return out


def rows_of(n, seed=1):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    rows = [(i, [c + r.gauss(0, 0.5) for c in r.choice(centres)]) for i in range(n)]
    rows += [(n + 50, None), (n + 51, []), (n + 52, [0.0] * 16), (n + 53, [float("nan")] * 16), (n + 54, [None] + [1.0] * 15), (n + 55, [1.0] * 3), (n + 100, rows[0][1]), (n + 150, rows[0][1])]
    return rows


def test_recall_and_scores(spark):
    rows = rows_of(2000)
    vectors = spark.createDataFrame([(i, v, 3) for i, v in rows], SCHEMA)
    want = brute(rows, 5, {i for i, _ in rows if i % 50 == 0})
    got = {}
    for x in N.nearest(vectors, vectors.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
        assert x.rank == len(got[x.query_id])
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        assert len(found) == 5
        exact = dict(brute(rows, len(rows), {q})[q]) if q == 0 else dict(want[q])
        hits += sum(i in dict(want[q]) for i, _ in found)
        for i, s in found:
            if i in exact:
                assert abs(s - exact[i]) < 1e-12
    assert hits >= 0.9 * 5 * len(want)


def test_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [1.0, 0.0], 1)], SCHEMA)
    got = N.nearest(few, few.where("vec_id = 0")).collect()
    assert [(x.rank, x.vec_id) for x in sorted(got, key=lambda x: x.rank)] == [(1, 2), (2, 1)]
    assert N.nearest(few.limit(0), few).collect() == []
    assert N.nearest(few.where("vec_id < 0"), few.where("vec_id < 0")).collect() == []


def test_ties_go_to_smaller_ids(spark):
    r = random.Random(4)
    same, other = [r.gauss(0, 1) for _ in range(16)], [[r.gauss(0, 1) for _ in range(16)] for _ in range(300)]
    rows = [(i, same if i % 10 == 0 else other[i], 1) for i in range(300)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for x in N.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        assert x.vec_id == [i for i in range(0, 300, 10) if i != x.query_id][x.rank - 1]


def test_repeated_ids(spark):
    """Ten rows of each query id: they leave room for all others, and others find them once for each row."""
    r = random.Random(9)
    rows = [(i, [r.gauss(0, 1) for _ in range(16)], 1) for i in range(300)]
    near = {i: v for i, v, _ in rows}
    rows += [(i, [x + r.gauss(0, 0.01) for x in near[i]], 1) for i in range(0, 300, 50) for _ in range(9)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(4)
    plain = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows]
    hits = 0
    got = {}
    for x in N.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert sorted(got) == list(range(0, 300, 50)) and all(len(f) == 5 and q not in f for q, f in got.items())
    for q, found in got.items():
        x = np.array(min(tuple(np.array(v, np.float32).astype(float)) for i, v, _ in rows if i == q))
        want = sorted((-(x @ y) / math.sqrt((x @ x) * (y @ y)), i) for i, y in plain if i != q)[:5]
        hits += sum(a == b for a, b in zip(sorted(found), sorted(i for _, i in want), strict=True))
    assert hits >= 0.9 * 30


def test_large_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 50)
    monkeypatch.setattr(N, "QUERY_BLOCK", 7)
    rows = rows_of(800, 3)
    vectors = spark.createDataFrame([(i, v, 3) for i, v in rows], SCHEMA)
    want = brute(rows, 5, {i for i, _ in rows if i % 50 == 0})
    got = {}
    for x in N.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    assert sum(len(got[q] & {i for i, _ in f}) for q, f in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_scan_keeps_the_nearest():
    """With a wide margin the tests lose nothing, whatever the pieces; ties stay."""
    r = np.random.default_rng(3)
    x = r.standard_normal((32, 500))
    x[:, 400:] = x[:, :100]
    for piece in (7, 64, 1000):
        N.PIECE, was = piece, N.PIECE
        try:
            for _ in range(20):
                q = r.standard_normal(32)
                found = N.scan([x[:16], x[16:]], q, 6, epsilon=50.0)
                d = ((x - q[:, None]) ** 2).sum(0)
                assert set(np.flatnonzero(d <= np.sort(d)[5] + 1e-12)) <= set(found.tolist())
        finally:
            N.PIECE = was


def test_recall_on_the_tables(spark):
    """Against brute force over the given vectors."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = vectors.select("vec_id", "embedding").toPandas()
    x = np.stack(rows["embedding"].to_numpy()).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    ids = rows["vec_id"].to_numpy()
    got = {}
    for f in N.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got.setdefault(f.query_id, set()).add(f.vec_id)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = u @ u[q]
        s[q] = -2
        hits += len(got[ids[q]] & set(ids[np.argsort(-s, kind="stable")[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(got)
