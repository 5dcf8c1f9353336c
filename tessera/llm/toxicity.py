"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is a bag of sentences. A sentence is toxic with probability sigmoid(bias + the weights of its words' features), and
a document is toxic unless none of its sentences is and no leak occurs: P = 1 - (1 - leak) * prod(1 - p_sentence), a noisy-or.
Weights, bias and leak are fitted to document labels alone by gradient steps on the likelihood, so sentence scores come out of training
although no sentence is labelled, and ``locate`` names the offending sentences of each document.

Features of a word are the word and its first 5, 6 and 7 bytes, so inflected forms share weights. Fitting takes at most ``FIT_ROWS``
labelled rows, those whose ids hash lowest, and ``FIT_BYTES`` of their texts; scoring runs over whole texts of all documents.

Defined cases: a null or empty text has no sentences and gets the leak as its score; labels that are null, or have no document, are ignored; with no
labels of both kinds the score is the share of toxic labels; a score of exactly the threshold counts as toxic; repeated rows are scored each on its own; a very long text is scored whole,
with one list of its words in memory; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lowest_hashes, slices, text_bytes

FIT_ROWS, FIT_BYTES = 8_000, 64 << 20
PREFIXES = (5, 6, 7)
LEAST_TOXIC = 4
STEPS = 400
MOST_WORDS = 300_000
THRESHOLD = 0.3

_ENDS = b".!?\n\r"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_SIGNS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b not in _ENDS)
#: Lower-cases A-Z, makes signs spaces and sentence ends line ends; all in one pass over the bytes.
_PLAIN = bytes.maketrans(_UPPER + _SIGNS + _ENDS, _LOWER + b" " * len(_SIGNS) + b"\n" * len(_ENDS))


def sentences(text: bytes | None) -> list[list[bytes]]:
    """The words of each sentence; sentences without words are left out."""
    return [w for s in (text or b"").translate(_PLAIN).split(b"\n") if (w := s.split())]


def features(word: bytes) -> list[bytes]:
    return [word, *(word[:k] + b"*" for k in PREFIXES if len(word) > k)]


class Model:
    """Feature weights, bias and leak."""

    def __init__(self, weights: dict[bytes, float], bias: float, leak: float):
        self.weights, self.bias, self.leak = weights, bias, leak
        self._words: dict[bytes, float] = {}

    def __getstate__(self):
        return self.weights, self.bias, self.leak

    def __setstate__(self, state):
        self.__init__(*state)

    def word(self, word: bytes) -> float:
        found = self._words.get(word)
        if found is None:
            if len(self._words) >= MOST_WORDS:
                self._words.clear()
            get = self.weights.get
            found = self._words[word] = sum(get(f, 0.0) for f in features(word))
        return found

    def sentence(self, words: list[bytes]) -> float:
        x = self.bias + sum(map(self.word, words))
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0

    def score(self, text: bytes | None) -> float:
        clean = 1 - self.leak
        for s in sentences(text):
            clean *= 1 - self.sentence(s)
        return min(1.0, max(0.0, 1 - clean))


def _select(bags: list[tuple[list[list[bytes]], int]]) -> list[bytes]:
    """Features that toxic documents have more often than others."""
    of = lambda bag: {f for s in bag for w in s for f in features(w)}
    toxic: Counter = Counter()
    for bag, y in bags:
        if y:
            toxic.update(of(bag))
    toxic = Counter({f: n for f, n in toxic.items() if n >= LEAST_TOXIC})
    other: Counter = Counter()
    n1 = sum(y for _, y in bags)
    n0 = len(bags) - n1
    for bag, y in bags:
        if not y:
            other.update(of(bag) & toxic.keys())
    return sorted(f for f, n in toxic.items() if n / n1 > 3 * (other[f] + 0.5) / n0)


def fit(rows: list[tuple[bytes | None, int]], steps: int = STEPS) -> Model:
    """rows: (text, 0 or 1)."""
    bags = [(sentences(t), y) for t, y in rows]
    n1 = sum(y for _, y in bags)
    if not n1 or n1 == len(bags):
        return Model({}, -50.0, min(max(n1 / max(len(bags), 1), 1e-6), 1 - 1e-6))
    names = _select(bags)
    ids = {f: i for i, f in enumerate(names)}
    bags_ = Bags([[[ids[f] for w in s for f in features(w) if f in ids] for s in bag] for bag, _ in bags], [y for _, y in bags], len(names))
    x = np.append(np.zeros(len(names)), [-6.0, math.log(n1 / len(bags) / 4)])
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        _, grad = bags_.likelihood(x)
        grad[:-2] -= 0.5 * x[:-2]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        x = x + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        x[-2:] = np.clip(x[-2:], (-14, -12), 2)
    return Model({f: float(w) for f, w in zip(names, x, strict=False) if abs(w) > 1e-3}, float(x[-2]), 1 / (1 + math.exp(-x[-1])))


class Bags:
    """Documents as sentences of feature numbers, end to end; sentences without features differ only by document, so they are counted."""

    def __init__(self, bags: list[list[list[int]]], labels: list[int], n_features: int):
        self.n, self.y, self.empty = n_features, np.array(labels, float), np.zeros(len(bags))
        flat: list[int] = []
        starts: list[int] = []
        owner: list[int] = []
        for d, bag in enumerate(bags):
            for s in bag:
                if s:
                    starts.append(len(flat))
                    flat += s
                    owner.append(d)
                else:
                    self.empty[d] += 1
        self.flat, self.starts, self.owner = np.array(flat, np.int64), np.array(starts, np.int64), np.array(owner, np.int64)
        self.lengths = np.diff(np.append(self.starts, len(flat)))

    def likelihood(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Log-likelihood of the labels and its gradient. x: weights, bias, and the leak's log-odds."""
        bias, leak = x[-2], x[-1]
        z = bias + (np.add.reduceat(x[self.flat], self.starts) if len(self.starts) else np.zeros(0))
        p, p0, pl = 1 / (1 + np.exp(-z)), 1 / (1 + math.exp(-bias)), 1 / (1 + math.exp(-leak))
        log_clean = math.log(1 - pl) + self.empty * math.log(1 - p0) + np.bincount(self.owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(self.y))
        clean = np.exp(log_clean)
        value = float(np.where(self.y > 0, np.log(np.maximum(1 - clean, 1e-9)), log_clean).sum())
        g = np.where(self.y > 0, clean / np.maximum(1 - clean, 1e-9), -1.0)  # d loglik / d(-log clean)
        gs = g[self.owner] * p  # d(-log(1-p))/dx = p
        return value, np.append(np.bincount(self.flat, np.repeat(gs, self.lengths), self.n), [gs.sum() + (g * self.empty).sum() * p0, g.sum() * pl])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> Model:
    """Fitted on at most `most` labelled ids, those that hash lowest, each whose text still fits into `most_bytes` with those before it. An id's text is its smallest."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"))
    chosen = lowest_hashes(known, "doc_id", most).withColumn("h", F.xxhash64("doc_id"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    sizes = docs.select("doc_id", size.alias("size")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "h", "y").agg(F.max("size").alias("size"))
    upto, total = [], 0
    for x in sorted(sizes.collect(), key=lambda x: (x.h, x.doc_id)):  # at most `most` rows
        if total + x.size <= most_bytes:  # a text that doesn't fit is passed over, and the next ones may
            total += x.size
            upto.append((x.doc_id, x.y))
    taken = docs.sparkSession.createDataFrame(upto, "doc_id bigint, y int")
    texts = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = texts.orderBy("doc_id").toArrow()
    return fit(list(zip(text_bytes(rows.column("text")), rows.column("y").to_pylist(), strict=True)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = [model.score(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(doc_id, sentence, score, words) of sentences that score at least `least`; sentence counts those with words from 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: list[list] = [[], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch.column("text")), strict=True):
                for i, s in enumerate(sentences(text)):
                    if (p := model.sentence(s)) >= least:
                        for column, value in zip(out, (doc_id, i, p, b" ".join(s).decode("utf-8", "replace")), strict=True):
                            column.append(value)
            types = (pa.int64(), pa.int32(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "sentence", "score", "words"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, sentence int, score double, words string")
