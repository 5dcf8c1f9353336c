import random

import numpy as np

from tessera.operators import dedup
from tessera.plans import queries as Q


def test_greedy_jaccard_over_thousands(spark, tmp_path):
    r = random.Random(2)
    words = [f"w{k}" for k in range(500)]
    rows = []
    for i in range(1500):
        copy = list(r.choice(rows)[1].split()) if i and r.random() < 0.5 else r.choices(words, k=r.randint(0, 60))
        if copy and r.random() < 0.5:
            copy[r.randrange(len(copy))] = r.choice(words)
        rows.append((i, " ".join(copy)))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for i, text in rows:
        w = text.split()
        own = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else set(w)
        if not any(own | other and len(own & other) / len(own | other) >= 0.92 for _, other in kept):
            kept.append((i, own))
    assert sorted(x.ord for x in Q.QUERIES["jaccard_greedy"](spark, str(tmp_path)).collect()) == [i for i, _ in kept]


def test_cosine_clusters_link_large_groups(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.95, float(np.sqrt(1 - 0.95**2)), 0.0], [0.0, 0.0, 1.0]
    near = [[1.0, 1e-4 * k, 0.0] for k in range(1, 61)]  # not equal, so not folded
    vectors = [a] * 60 + [b] * 60 + [c] * 60 + near
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = {x.id: x.cluster for x in dedup.cosine_clusters(docs, 0.92).collect()}
    assert got == {i: 120 if 120 <= i < 180 else 0 for i in range(len(rows))}


def test_cosine_links_across_blocks(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal((120, 4))
    u = (x.astype(np.float32) / np.linalg.norm(x.astype(np.float32), axis=1, keepdims=True)).astype(float)
    label = np.arange(120)
    while True:
        new = np.array([label[u @ u[i] >= 0.95].min() for i in range(120)])
        if (new == label).all():
            break
        label = new
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    found = {i: i for i in range(120)} | {e.node: e.component for e in dedup.components(dedup.cosine_links(docs, 0.95, block=16)).collect()}
    assert found == {i: int(label[i]) for i in range(120)}
