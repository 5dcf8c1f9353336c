"""SimHash near-duplicates, linked by a self-join of the binary trie of all fingerprints.

Equal fingerprints are folded first, so a group of copies is one row from there on. The rest are the leaves of one
path-compressed binary trie. Its self-join starts with the root beside itself and goes down in pairs of nodes; the bits in which the
two paths differ add up, and a pair is dropped with all below it as soon as more than the budget differ, so every pair of
fingerprints within the budget is reached and no two others are compared to the end.

The join is dealt out at the top: nodes that hold at most ``SUBTRIE`` fingerprints (or the N / 2^14-th part of them all, if more) cut the
trie into subtries, hot prefixes deeper than others. The driver joins the trie of these nodes with itself, and each pair of subtries
that is left is a task's work. Fingerprints are distinct, so none has more than 2,080 others within two bits, and a hot group
can't make more links than that. A pair's links are folded to one edge for each fingerprint, to the smallest one that it reaches;
connected components of these edges give the groups, each named by its smallest doc_id.

Defined cases: a null or empty text has no words and fingerprint zero, and is linked like any other; texts of fewer words
than a shingle have one shingle of all their words; a bit that is set in exactly half of the hashes is 0; very long texts are hashed whole, with
one list of their words in memory; repeated rows and ids are kept, each with its group; rows with a null id link like any other, but a null id
names a group only if it has no other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import partitions_for, slices, text_bytes, words_of, written

SHINGLE = 3
SEED = 42
BUDGET = 2
#: A subtrie above this size is cut, unless there would be more than MOST_SUBTRIES; more node pairs than the last number are handled in parts.
SUBTRIE = 1 << 16
MOST_SUBTRIES = 1 << 14
MOST_PAIRS = 1 << 19

_LANES = np.zeros((2, 256), dtype="<u8")
for _b in range(8):
    _LANES[_b // 4] |= ((np.arange(256, dtype="<u8") >> np.uint64(_b)) & np.uint64(1)) << np.uint64(16 * (_b % 4))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit, lowest first. Lanes of 16 bits are added up, 65,535 hashes at most at a time."""
    out = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65_535):
        parts = hashes[start : start + 65_535].astype("<u8").view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            for half in range(2):
                lanes = _LANES[half][parts[:, byte]].sum(dtype="<u8")
                out[8 * byte + 4 * half : 8 * byte + 4 * half + 4] += np.array([lanes], dtype="<u8").view("<u2")
    return out


_WEIGHTS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of a text's word shingles, A-Z lower-cased, repeats included."""
    words = words_of(text.lower() if text else text)
    if not words:
        return np.empty(0, np.uint64)
    n = len(words)
    grams = zip(*(words[k : n - shingle + k + 1] for k in range(shingle)), strict=True) if n >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(g, seed) for g in map(b" ".join, grams)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The SimHash of these hashes as a signed 64-bit number: bits set in over half of them."""
    return int((_WEIGHTS[2 * bit_counts(hashes) > len(hashes)]).sum(dtype=np.uint64).view(np.int64))


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    return majority(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and fp (long) of every text."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = [fingerprint(t, shingle, seed) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(make, "doc_id bigint, fp bigint")


class Trie:
    """The path-compressed binary trie of ascending, distinct prefixes, none of which begins another. Nodes below ``n`` are its leaves, in order."""

    def __init__(self, values: np.ndarray, depths: np.ndarray | None = None):
        """values: unsigned, bits beyond a prefix being zero; depths: lengths of the prefixes, 64 if not given."""
        n = self.n = len(values)
        inner = max(0, n - 1)
        self.value, self.depth = np.concatenate([values, np.zeros(inner, np.uint64)]), np.zeros(n + inner, np.uint8)
        self.depth[:n] = 64 if depths is None else depths
        self.children = np.zeros((2, inner), np.int32)
        self.root = n if n > 1 else 0
        lo, hi = np.zeros(int(n > 1), np.int64), np.full(int(n > 1), n, np.int64)
        made = n
        while len(lo):
            first, last = values[lo], values[hi - 1]
            below = first ^ last
            for k in (1, 2, 4, 8, 16, 32):
                below |= below >> np.uint64(k)
            at = np.arange(made - n, made - n + len(lo))
            made += len(lo)
            self.value[at + n], self.depth[at + n] = first, 64 - np.bitwise_count(below)
            middle = np.searchsorted(values, last & ~(below >> np.uint64(1)))
            sides, after = [], made
            for side, (x, y) in enumerate(((lo, middle), (middle, hi))):
                many = y - x > 1
                self.children[side, at] = np.where(many, after + np.cumsum(many) - 1, x)
                after += int(many.sum())
                sides.append((x[many], y[many]))
            lo, hi = (np.concatenate(v) for v in zip(*sides, strict=True))


def node_pairs(left: Trie, right: Trie, budget: int, counts: Counter | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves, one of each trie, whose common depths differ in at most `budget` bits; each pair once if both are the same trie, without a leaf beside itself.

    counts, if given, learns how many node pairs were visited and how many of them pruned.
    """
    same = left is right
    stack = [(np.array([left.root], np.int32), np.array([right.root], np.int32))] if left.n and right.n else []
    while stack:
        a, b = stack.pop()
        if len(a) > MOST_PAIRS:
            half = len(a) // 2
            stack += [(a[half:], b[half:]), (a[:half], b[:half])]
            continue
        common = np.minimum(left.depth[a], right.depth[b])
        errors = np.bitwise_count((left.value[a] ^ right.value[b]) >> (np.uint64(64) - common))
        near = errors <= budget
        if counts is not None:
            counts.update(visited=len(a), pruned=len(a) - int(near.sum()))
        a, b = a[near], b[near]
        done = (a < left.n) & (b < right.n)
        found = done & (a != b) if same else done
        if found.any():
            yield a[found], b[found]
        a, b = a[~done], b[~done]
        twin = (a == b) if same else np.zeros(len(a), bool)
        x, y = (left.children[side, a[twin] - left.n] for side in (0, 1))
        a, b = a[~twin], b[~twin]
        down = (a >= left.n) & ((b < right.n) | (left.depth[a] <= right.depth[b]))  # the shallower inner node has the next branch
        l, r = a[down], b[~down]
        parts = [(x, x), (y, y), (x, y)] if same else []
        parts += [(left.children[side, l - left.n], b[down]) for side in (0, 1)] + [(a[~down], right.children[side, r - right.n]) for side in (0, 1)]
        a, b = (np.concatenate(v) for v in zip(*parts, strict=True))
        if len(a):
            stack.append((a, b))


def trie_links(fps: np.ndarray, cut: int = 0, budget: int = BUDGET, counts: Counter | None = None) -> np.ndarray:
    """For each of these ascending, distinct fingerprints the index of the smallest one that it reaches over pairs within the budget: all
    pairs, or, with a cut, those of one before the cut and one after."""
    labels = np.arange(len(fps))
    left = Trie(fps[: cut or len(fps)])
    right = Trie(fps[cut:]) if cut else left
    for a, b in node_pairs(left, right, budget, counts):
        a, b = a, b + cut
        while len(a):  # roots fall to the smallest root beside them until both ends of every pair have one
            la, lb = labels[a], labels[b]
            apart = la != lb
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
            while not np.array_equal(labels[labels], labels):
                labels[:] = labels[labels]
    return labels


def subtries(reps: DataFrame, most: int, step: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(values, depths) of the nodes that cut the trie into subtries of at most `most` fingerprints, ascending.

    The driver sees counts of prefixes: 2^step at first, then 16 for each that is still too large.
    """
    spark = reps.sparkSession
    levels: list[dict[int, int]] = [{} for _ in range(65)]
    here, depth, large = reps, 0, [0]
    while large and depth < 64:
        if depth:
            here = reps.join(F.broadcast(spark.createDataFrame([(x,) for x in large], "p bigint")), F.shiftrightunsigned("fp", 64 - depth) == F.col("p"), "left_semi")
        depth = depth + 4 if depth else step
        found = here.groupBy(F.shiftrightunsigned("fp", 64 - depth).alias("p")).count().collect()
        levels[depth] = {x["p"] & (1 << depth) - 1: x["count"] for x in found}
        large = [x["p"] for x in found if x["count"] > most]
    for above, below in zip(levels[-2::-1], levels[:0:-1], strict=True):  # nodes between the counted depths
        for p, c in below.items():
            above.setdefault(p >> 1, c + below.get(p ^ 1, 0))
    out, stack = [], [(0, 0)]
    while stack:
        d, p = stack.pop()
        c = levels[d].get(p, 0)
        if c > most and d < 64:
            stack += [(d + 1, 2 * p + 1), (d + 1, 2 * p)]
        elif c:
            out.append((p << 64 - d, d))
    values, depths = zip(*out, strict=True) if out else ((), ())
    return np.array(values, np.uint64), np.array(depths, np.uint8)


def links(reps: DataFrame, budget: int = BUDGET, most: int = SUBTRIE, per_task: int = 400_000) -> DataFrame:
    """Edges (a, b) between fingerprints whose closure holds every pair within the budget. reps: a stable table of distinct fp."""
    spark = reps.sparkSession
    n = reps.count()
    starts, depths = subtries(reps, max(most, n // MOST_SUBTRIES))
    top = Trie(starts, depths)
    pairs = [(np.arange(len(starts)), np.arange(len(starts))), *((np.minimum(a, b), np.maximum(a, b)) for a, b in node_pairs(top, top, budget))]
    low, high = (np.concatenate(x).astype(np.int64) for x in zip(*pairs, strict=True))
    # For each subtrie the pairs that it is in, and whether it is the higher one there.
    owner, which = np.concatenate([low, high[low < high]]), np.concatenate([np.arange(len(low)), np.flatnonzero(low < high)])
    upper = np.arange(len(owner)) >= len(low)
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(len(starts) + 1))
    held = spark.sparkContext.broadcast((starts, which[order], upper[order], edges))  # about a hundred pairs for each of at most MOST_SUBTRIES or so nodes

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, which, upper, edges = held.value
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            node = np.searchsorted(starts, fps.view(np.uint64), side="right") - 1
            times = edges[node + 1] - edges[node]
            at = np.repeat(edges[node] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
            for k in range(0, len(at), 1 << 20):
                x = at[k : k + (1 << 20)]
                yield pa.RecordBatch.from_arrays([pa.array(which[x]), pa.array(upper[x]), pa.array(np.repeat(fps, times)[k : k + (1 << 20)])], names=["pair", "upper", "fp"])

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        fps, side = table.column("fp").to_numpy().view(np.uint64), table.column("upper").to_numpy()
        below, above = np.sort(fps[~side]), np.sort(fps[side])
        fps = np.concatenate([below, above])
        labels = trie_links(fps, len(below) if len(above) else 0, budget) if len(below) else np.arange(len(fps))
        moved = np.flatnonzero(labels != np.arange(len(labels)))
        signed = fps.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[labels[moved]])], names=["a", "b"])

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by pair; one pair is held at a time."""
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            pair = batch.column("pair").to_numpy()
            cuts = [0, *(np.flatnonzero(pair[1:] != pair[:-1]) + 1).tolist(), len(pair)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if parts and y > x and parts[-1].column("pair")[0].as_py() != pair[x]:
                    yield solve(parts)
                    parts = []
                if y > x:
                    parts.append(batch.slice(x, y - x))
        if parts:
            yield solve(parts)

    tasks = min(max(1, len(low)), partitions_for(spark, n * max(1, len(which) // max(1, len(starts))), per_task))
    dealt = reps.select("fp").mapInArrow(deal, "pair bigint, upper boolean, fp bigint")
    return dealt.repartition(tasks, "pair").sortWithinPartitions("pair").mapInArrow(join, "a bigint, b bigint")


def classes(reps: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(fp, class): the smallest fingerprint, as a signed number, reachable from each. reps: a stable table of distinct fp."""
    found = components(links(reps, budget))
    return reps.select("fp").join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("class"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, budget: int = BUDGET, seed: int = SEED) -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links of at most `budget` differing bits."""
    made = written(fingerprints(docs, shingle, seed), "fingerprints")
    reps = written(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "representatives")
    found = written(reps.join(classes(reps, budget), "fp"), "classes")
    named = found.groupBy("class").agg(F.min("least").alias("component_id"))  # null only if the whole group has no id
    groups = found.join(named, "class").select("fp", "component_id")
    return made.join(groups, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(column: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
