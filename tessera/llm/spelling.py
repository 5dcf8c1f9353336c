"""Spelling variants: words that differ by one code point, found by two-dimensional range reporting.

Two words are near if an edit position splits them into an equal prefix and an equal suffix. Words of one length are the points of a grid: their rank in forward order and their rank in
the order of reversed words. A prefix is an interval of the first, a suffix one of the second, and the words that have both are the points of a rectangle, which a wavelet tree
over the permutation from one order to the other reports. A word of that length asks at each position for the words that differ there alone; a word shorter by one asks for
those that have one more code point there. Of positions that give the same longer word, the first counts.

No task holds the grid of all words. Each word is cut into ``PARTS`` parts; an edit falls into one of them, and the rest of both words is then equal. So a word goes, for each part, to the group of its
length, that part and a hash of the rest, and asks there for edits inside that part only: every near pair meets exactly once. Groups of a length are as many as its words need (``GROUP``), and
a rest that many words have is bounded by the number of ways to fill a part. A group hands over, for each of its words, how many are near and the most frequent of them, not pairs;
these are summed by word. Forms are then followed to the last by pointer doubling: frequencies double along a chain, so rounds are few.

Defined cases: a null text has no words; a null id is the empty text before the colon, as the id of no document; repeated rows count as often as they stand there; equal frequencies go
to the smallest word in code-point order; a word without near ones is its own root; an empty table gives no rows; a very long text is one row in memory; a very long run is a word like any other, and takes memory
of its length for each group it is in; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import discard
from .common import slices, text_bytes, written

DAMAGE = 97
SHORTEST = 5
LEAST = 3
PARTS = 4
#: Words of one length and part in a group, about.
GROUP = 20_000
#: Words that a task counts before it hands them over, and rectangles that are asked for together.
COUNTED = 500_000
ASKED = 1 << 18
RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def damaged(run: str, head: int, modulus: int = DAMAGE) -> str:
    """A lower-cased run without one code point, if its checksum, continued from that of `<doc_id>:`, is divisible."""
    h = zlib.crc32(run.encode(), head)
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word and n of the words of all texts that are long and frequent enough; counts of a task's texts are added before they are shuffled."""

    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                if not text:
                    continue
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # bytes.lower() changes A-Z alone; a run of `shortest` letters or less can't come out long enough with one less
                for word, n in Counter(RUNS.findall(text.lower().decode())).items():
                    if len(word) >= shortest and len(word := damaged(word, head)) >= shortest:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("n")).where(F.col("n") >= least)


class WaveletTree:
    """A permutation, level by level from the highest bit: for each level, the zeros before each place after a stable split by the bits above."""

    def __init__(self, values: np.ndarray):
        self.n = n = len(values)
        self.levels = max(1, int(n - 1).bit_length()) if n else 1
        self.zeros: list[np.ndarray] = []
        for level in range(self.levels - 1, -1, -1):
            one = (values >> level & 1).astype(bool)
            before = np.zeros(n + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate((values[~one], values[one]))

    def report(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rectangles of places lo to hi and values least to end (ends not included): numbers of rectangles and the values found in them."""
        asked, base = np.arange(len(lo), dtype=np.int64), np.zeros(len(lo), np.int64)
        for depth, before in enumerate(self.zeros):
            half = 1 << self.levels - 1 - depth
            zeros = int(before[-1])
            lo0, hi0 = before[lo], before[hi]
            lo1, hi1 = zeros + lo - lo0, zeros + hi - hi0
            left = np.flatnonzero((lo0 < hi0) & (base < end[asked]) & (base + half > least[asked]))
            right = np.flatnonzero((lo1 < hi1) & (base + half < end[asked]) & (base + 2 * half > least[asked]))
            lo, hi = np.concatenate((lo0[left], lo1[right])), np.concatenate((hi0[left], hi1[right]))
            base = np.concatenate((base[left], base[right] + half))
            asked = np.concatenate((asked[left], asked[right]))
        return asked, base


def _order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes in order, and the length of the prefix that each shares with the row before it, -1 for the first."""
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return order, np.concatenate(([-1], shared)) if len(rows) else shared


class Grid:
    """Words of one length, and words shorter by one that ask as well."""

    def __init__(self, words: list[bytes], length: int):
        """words have `length` or `length` - 1 code points, one byte each, and are different."""
        self.length, self.n = length, len(words)
        self.rows = np.frombuffer(b"".join(w.ljust(length, b"\0") for w in words), np.uint8).reshape(-1, length)
        self.full = self.rows[:, -1] != 0
        back = np.frombuffer(b"".join(w[::-1].ljust(length, b"\0") for w in words), np.uint8).reshape(-1, length)
        self.forward, self.shared = _order(self.rows)
        self.backward, self.shared_back = _order(back)
        place, value = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        self.points, self.points_back = self.forward[self.full[self.forward]], self.backward[self.full[self.backward]]
        value[self.points_back] = np.arange(len(self.points_back))
        place[self.points] = np.arange(len(self.points))
        self.tree = WaveletTree(value[self.points])
        #: Points before each row in order, to make intervals of rows intervals of points.
        self.before = np.concatenate(([0], np.cumsum(self.full[self.forward])))
        self.before_back = np.concatenate(([0], np.cumsum(self.full[self.backward])))

    @staticmethod
    def _intervals(order: np.ndarray, shared: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row the interval of points that have its first `size` bytes."""
        first = np.flatnonzero(shared < size)
        ends = np.append(first[1:], len(order))
        group = np.cumsum(shared < size) - 1
        lo, hi = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        lo[order], hi[order] = before[first][group], before[ends][group]
        return lo, hi

    def near(self, positions: range) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row that asks, row of full length that is near it) whose edit is at one of the positions of the longer word."""
        waiting: list[tuple] = []
        size = 0
        for i in positions:
            lo, hi = self._intervals(self.forward, self.shared, self.before, i)
            least, end = self._intervals(self.backward, self.shared_back, self.before_back, self.length - 1 - i)
            own = self.full.astype(np.int64)  # a point stands in its own rectangle
            asks = np.flatnonzero((hi - lo > own) & (end - least > own))
            if len(asks):
                waiting.append((asks, lo[asks], hi[asks], least[asks], end[asks], np.full(len(asks), i)))
                size += len(asks)
            if size >= ASKED:
                yield self._found(waiting)
                waiting, size = [], 0
        if waiting:
            yield self._found(waiting)

    def _found(self, waiting: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        asks, lo, hi, least, end, at = map(np.concatenate, zip(*waiting, strict=True))
        number, value = self.tree.report(lo, hi, least, end)
        a, b, at = asks[number], self.points_back[value], at[number]
        # a run of equal code points can be lengthened at each of its places: only the first counts
        again = ~self.full[a] & (at > 0) & (self.rows[b, at] == self.rows[a, np.maximum(at, 1) - 1])
        keep = (a != b) & ~again
        return a[keep], b[keep]


def part_edges(length: int, parts: int = PARTS) -> list[int]:
    return [j * length // parts for j in range(parts + 1)]


def group_rows(words: DataFrame, parts: int = PARTS, per_group: int = GROUP) -> DataFrame:
    """length, part, salt, word, n: each word for each part of its own length, and of the next, where it asks only."""
    sizes = words.groupBy(F.length("word").alias("of")).count().where(F.col("count") > per_group)
    roles = words.select("word", "n", F.length("word").alias("own")).withColumn("length", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    cut = roles.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    start, end = (F.floor((F.col("part") + k) * F.col("length") / parts).cast("int") for k in (0, 1))
    less = F.col("length") - F.col("own")  # a word shorter by one lacks a code point of the part
    rest = F.xxhash64(F.substring("word", F.lit(1), start), F.expr("substring(word, {0})".format("_from")))
    cut = cut.withColumn("_from", end - less + 1)
    cut = cut.withColumn("h", rest).where(end > start)
    groups = F.ceil(F.coalesce(F.col("count"), F.lit(1)) / per_group).cast("long")
    return cut.join(sizes.withColumnRenamed("of", "length"), "length", "left").select("length", "part", F.pmod("h", groups).alias("salt"), "word", "n")


def _group(length: int, part: int, words: list[str], counts: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word how many are near by an edit in the part, and the number of the best of them, -1 for none."""
    grid = Grid([w.encode("latin-1") for w in words], length)
    near = np.zeros(len(words), np.int64)
    best = np.full(len(words), len(words), np.int64)
    order = np.array(sorted(range(len(words)), key=lambda i: (-counts[i], words[i])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    edges = part_edges(length, parts)
    for a, b in grid.near(range(edges[part], edges[part + 1])):
        near += np.bincount(a, minlength=len(words))
        np.minimum.at(best, a, rank[b])
        shorter = ~grid.full[a]  # points ask for themselves, but not for words shorter than they are
        near += np.bincount(b[shorter], minlength=len(words))
        np.minimum.at(best, b[shorter], rank[a[shorter]])
    return near, order, best


def near_words(words: DataFrame, parts: int = PARTS, per_group: int = GROUP) -> DataFrame:
    """word, n_near, best_n, best: words that have near ones, how many, and the most frequent of them."""

    def run(table: pa.Table) -> pa.Table:
        texts, counts = table.column("word").to_pylist(), table.column("n").to_numpy()
        near, order, best = _group(table.column("length")[0].as_py(), table.column("part")[0].as_py(), texts, counts, parts)
        have = np.flatnonzero(near)
        to = order[best[have]]
        return pa.table({"word": pa.array([texts[i] for i in have], pa.string()), "c": near[have], "best_n": counts[to], "best": pa.array([texts[i] for i in to], pa.string())})

    found = group_rows(words, parts, per_group).groupBy("length", "part", "salt").applyInArrow(run, "word string, c bigint, best_n bigint, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("x")
    return found.groupBy("word").agg(F.sum("c").alias("n_near"), first).select("word", "n_near", (-F.col("x.less")).alias("best_n"), F.col("x.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for word and form, by pointer doubling: in each round a word's form becomes the form of its form. Ends when a round changes nothing."""
    links = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        done = joined.where("moved").limit(1).count() == 0
        discard(links)
        links = joined
        if done:
            return links.select("word", "root")


def variants(docs: DataFrame, per_group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = written(word_counts(docs), "words")
    near = near_words(words, per_group=per_group)
    formed = F.col("best_n") >= 2 * F.col("n")
    table = written(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "variants")
    found = table.join(roots(table.where("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
