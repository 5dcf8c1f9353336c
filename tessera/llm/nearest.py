"""Approximate nearest neighbours by cosine: probed lists scanned with adaptive dimension sampling.

Unit vectors are dealt into lists by their nearest centroid; centroids are fitted on a bounded sample (at most ``FIT_ROWS``), every row is
indexed, and lists grow in number with the root of the table's rows, up to one for eight sampled rows. A random rotation spreads a vector's length evenly over its dimensions, so the distance over the first d of D
rotated dimensions, scaled by D/d, estimates the whole. Within a probed list vectors lie in column blocks; after each block a
candidate is abandoned when its estimate exceeds the distance of the best k so far by more than the test's margin,
(1 + EPSILON / sqrt(d)); the best so far grow better from one piece of ``PIECE`` candidates to the next. What is left is scored exactly, in double precision on the original vectors.

How many lists a query probes is calibrated on the same sample: the least number that finds ``GOAL`` of the true
neighbours among its rows, so clustered data probe few lists and data without structure probe many.

Queries are sent to the lists that they probe and nowhere else. Lists are cut into chunks of bounded size, and the queries of a list into blocks of bounded size, so a task holds one chunk and one block
however large a list is; a vector is copied once for each block of its list's queries. Each pair of chunk and block yields k rows for a query; a window over queries keeps the best.

Defined cases: null, empty, zero vectors and those with null or non-finite components take no part, nor do vectors whose dimension isn't
that of most sampled rows; rows of a repeated id are candidates each for the queries of other ids, where the id may then stand several times, and one query together, that of the smallest of
their vectors that take part, for which none of them is a candidate; ties go to the smaller id; with fewer candidates than k all probed ones are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lowest_hashes

K = 5
FIT_ROWS, FEW_ROWS = 65_536, 8_000
GOAL = 0.97
EPSILON = 2.1
BLOCK = 16
CHUNK, PIECE = 4_096, 1_024
QUERY_BLOCK = 4_096
SEED = 7


def vectors_of(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their vectors as float64)."""
    if not isinstance(column, pa.Array):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(column), 0))
    right = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(right)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
    good = np.isfinite(flat).all(1) & (flat != 0).any(1)
    return right[good], flat[good]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Index:
    """Rotation, centroids and the calibrated number of probes."""

    def __init__(self, sample: np.ndarray, rows: int, k: int = K, goal: float = GOAL, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0]
        u = unit(sample)
        n_lists = int(np.clip(np.sqrt(rows) / 2, 1, max(1, len(u) // 8)))
        self.centroids = u[rng.choice(len(u), n_lists, replace=False)]
        for _ in range(8):
            own = (u @ self.centroids.T).argmax(1)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, own, u)
            some = (sums != 0).any(1)
            self.centroids[some] = unit(sums[some])
        self.probes = self._calibrate(u, rng, k, goal)

    def _calibrate(self, u: np.ndarray, rng, k: int, goal: float) -> int:
        own = self.assign(u)
        asked = rng.choice(len(u), min(256, len(u)), replace=False)
        near = u[asked] @ u.T
        near[np.arange(len(asked)), asked] = -2
        found = np.argsort(-near, 1)[:, : min(k, len(u) - 1)]
        place = np.argsort(np.argsort(-(u[asked] @ self.centroids.T), 1), 1)  # of each list for each query
        ranks = np.sort(np.take_along_axis(place, own[found], 1).ravel())
        return int(ranks[min(len(ranks) - 1, int(np.ceil(goal * len(ranks))))]) + 1 if len(ranks) else len(self.centroids)

    def assign(self, u: np.ndarray) -> np.ndarray:
        return (u @ self.centroids.T).argmax(1)

    def probed(self, u: np.ndarray) -> np.ndarray:
        """The lists each query probes, nearest first."""
        return np.argsort(-(u @ self.centroids.T), 1, kind="stable")[:, : self.probes]


def scan(columns: list[np.ndarray], query: np.ndarray, k: int, epsilon: float = EPSILON, out: np.ndarray | None = None) -> np.ndarray:
    """Candidates that the tests leave, among which are the k nearest with high probability. Those that `out` marks take no part, not even in the threshold.

    columns: blocks of rotated dimensions, each (dimensions, candidates). Pieces of candidates come one after the other, and the k best distances so far
    are the threshold; in the first piece, those of the k that its first block puts first.
    """
    dim, n = sum(len(c) for c in columns), columns[0].shape[1]
    ends = np.cumsum([len(c) for c in columns])

    def distances(c: np.ndarray, end: int, at) -> np.ndarray:
        d = c[:, at] - query[end - len(c) : end, None]
        return np.einsum("ij,ij->j", d, d)

    best, kept, found = np.empty(0), [], []
    for start in range(0, n, PIECE):
        alive = np.arange(start, min(start + PIECE, n))
        partial = distances(columns[0], ends[0], slice(start, start + len(alive)))
        if out is not None:
            stay = ~out[alive]
            alive, partial = alive[stay], partial[stay]
            if not len(alive):
                continue
        if len(best) < k:
            seeds = alive[np.argsort(partial, kind="stable")[:k]]
            best = np.sort(np.append(best, sum(distances(c, e, seeds) for c, e in zip(columns, ends, strict=True))))[:k]
            again = seeds
        else:
            again = seeds[:0]
        radius = best[-1] if len(best) == k else np.inf
        for j, end in enumerate(ends):
            if j:
                partial = partial + distances(columns[j], end, alive)
            margin = 1.0 if end == dim else 1 + epsilon / np.sqrt(end)
            keep = partial * (dim / end) <= radius * margin * margin + 1e-9
            alive, partial = alive[keep], partial[keep]
        new = ~np.isin(alive, again)  # the seeds' distances are among the best already
        best = np.sort(np.append(best, partial[new]))[:k]
        kept.append(alive)
        found.append(partial)
    if not kept:
        return np.empty(0, np.int64)
    left, whole = np.concatenate(kept), np.concatenate(found)
    return left[whole <= best[-1] + 1e-9] if len(best) == k else left


def _search(index: Index, k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: a chunk of a list; right: a block of queries that probe it."""
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            x = np.asarray(left.column("embedding").combine_chunks().flatten().cast(pa.float64())).reshape(-1, index.dim)
            q = np.asarray(right.column("embedding").combine_chunks().flatten().cast(pa.float64())).reshape(-1, index.dim)
            ids, asked = left.column("vec_id").to_pylist(), right.column("query_id").to_pylist()
            own, unnamed = np.array([-1 if i is None else i for i in ids], dtype=np.int64), np.array([i is None for i in ids])
            ux, uq = unit(x), unit(q)
            rotated, turned = (ux @ index.rotation).T, uq @ index.rotation
            columns = [np.ascontiguousarray(rotated[i : i + BLOCK]) for i in range(0, index.dim, BLOCK)]
            norms = np.sqrt((x * x).sum(1))
            for row, name in enumerate(asked):
                mine = (own == name) & ~unnamed
                left_over = scan(columns, turned[row], k, out=mine if mine.any() else None)
                score = (x[left_over] * q[row]).sum(1) / (norms[left_over] * np.sqrt((q[row] * q[row]).sum()))  # row sums, so equal vectors tie exactly
                bad = ~np.isfinite(score)
                if bad.any():
                    score[bad] = ux[left_over[bad]] @ uq[row]
                best = np.lexsort((own[left_over], -score))[:k]
                out[0] += [name] * len(best)
                out[1] += [ids[i] for i in left_over[best]]
                out[2] += score[best].tolist()
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])

    return search


_OWN = "vec_id bigint, list int, embedding array<double>"


def fit(vectors: DataFrame, k: int = K, goal: float = GOAL) -> tuple[Index | None, int]:
    """The index and the number of rows, from a bounded sample: the rows whose ids hash lowest."""
    rows = vectors.count()
    most = int(np.clip(8 * np.sqrt(rows), FEW_ROWS, FIT_ROWS))  # 16 rows for each list
    sample = lowest_hashes(vectors.where("embedding IS NOT NULL AND vec_id IS NOT NULL"), "vec_id", most).select("embedding").toArrow().column("embedding")
    sizes = Counter(np.asarray(pa.compute.list_value_length(sample)).tolist())
    sizes.pop(0, None)
    if not sizes:
        return None, rows
    _, x = vectors_of(sample.combine_chunks(), max(sizes, key=sizes.get))
    return (Index(x, rows, k, goal) if len(x) else None), rows


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, goal: float = GOAL) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest of vectors (vec_id, embedding) found for each query (vec_id, embedding)."""
    spark = vectors.sparkSession
    vectors, queries = vectors.select("vec_id", "embedding"), queries.select("vec_id", "embedding")
    index, rows = fit(vectors, k, goal)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    def deal(probing: bool):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                taken, x = vectors_of(batch.column("embedding"), index.dim)
                lists = index.probed(unit(x)) if probing else index.assign(unit(x))[:, None]
                again = np.repeat(np.arange(len(x)), lists.shape[1])
                flat = pa.array(x[again].reshape(-1))
                offsets = pa.array(np.arange(len(again) + 1, dtype=np.int32) * index.dim)
                ids = batch.column("vec_id").cast(pa.int64()).take(pa.array(taken[again]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(lists.reshape(-1).astype(np.int32)), pa.ListArray.from_arrays(offsets, flat)], names=["vec_id", "list", "embedding"])

        return run

    own = vectors.mapInArrow(deal(False), _OWN)
    sizes = {r["list"]: r["count"] for r in own.groupBy("list").count().collect()}  # one row for each list
    held = np.cumsum(sorted(sizes.values()))
    index.probes = max(index.probes, min(len(index.centroids), int(np.searchsorted(held, k + 1)) + 1 + len(index.centroids) - len(sizes)))  # enough lists for k others
    sound = (F.size("embedding") == index.dim) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    once = queries.where("vec_id IS NOT NULL").where(sound).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    probes = once.mapInArrow(deal(True), _OWN)
    counts = {r["list"]: r["count"] for r in probes.groupBy("list").count().collect()}
    cuts = spark.createDataFrame([(a, -(-n // CHUNK), -(-counts[a] // QUERY_BLOCK)) for a, n in sizes.items() if a in counts], "list int, chunks int, blocks int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    placed = own.join(F.broadcast(cuts), "list").select("vec_id", "embedding", "list", mine("chunks").alias("chunk"), upto("blocks").alias("block"))
    asked = probes.join(F.broadcast(cuts), "list").select(F.col("vec_id").alias("query_id"), "embedding", "list", upto("chunks").alias("chunk"), mine("blocks").alias("block"))
    key = ["list", "chunk", "block"]
    found = placed.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(_search(index, k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
