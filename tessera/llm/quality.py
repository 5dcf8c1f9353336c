"""Quality by co-training: a classifier of the text and one of the page's metadata teach each other.

The content view sees measures of the text (length, capitals, digits, signs, repeats, line shape); the metadata view sees language, source and the
stated size, alone and together, and never the text. Both are logistic models over binned features. In each round both are fitted and calibrated
(Platt's sigmoid on labelled rows that are kept out of fitting), and each hands the other the unlabelled rows that it is surest of,
as many as a share ``GIVEN`` of the labelled rows, of both labels in proportion, with its probabilities as their pseudo-labels. A view is sure of a label if its doubt is at most half of what the
prior leaves, and at most 1 - ``LEAST_SURE``; a view that knows no more than the prior on the rows kept out hands over nothing. A view that knows
less there after a round's lesson, by more than ``WORSE``, forgets it. Last, the calibrated
log-odds of the views, each less the prior's, are weighted on the rows kept out, by one each as far as these rows don't speak against it, and added to the prior's.

Fitting takes at most ``FIT_ROWS`` labelled rows, those whose ids hash lowest. Pseudo-labels come from all unlabelled rows: one pass
writes the features of every document, a narrow table; equal features are one row of it, so copies are handed over once; and each round takes the surest of all its rows. Scoring covers all rows.

Defined cases: a null or empty text has measures of zero; null metadata are a value of their own; labels that are null or have no document are ignored;
of rows that share a labelled id the one of the smallest features stands for the id in fitting; equal certainties are ordered by a hash of the features;
without labels of both kinds every score is the share of good labels, or 1 if there are none; repeated rows are scored each on its own; a very long text is measured whole, with
one list of its words in memory; an empty table gives no rows; other columns are kept unless they bear the name of a result, which then replaces them.
"""

from __future__ import annotations

import math
import operator
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import discard
from .common import lowest_hashes, slices, text_bytes, written

FIT_ROWS = 6_000
ROUNDS = 4
LEAST_SURE = 0.9
GIVEN = 1 / 8
#: How much log-likelihood on the rows kept out a lesson may cost.
WORSE = 1.0
KEEP = 0.5
BINS = 16
MEASURES = 11
BUCKETS, SIZES, COARSE = 128, 24, 6

_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
_NOT_SIGN = bytes(b for b in range(256) if b > 0x7E or b < 0x21 or chr(b).isalnum() or chr(b) in ".,;:'\"-()?")


def measures(text: bytes | None) -> list[float]:
    """The content view of a text."""
    text = text or b""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    if not n:
        return [0.0] * MEASURES
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        math.log1p(n),
        len(text.translate(None, _NOT_UPPER)) / size,
        len(text.translate(None, _NOT_DIGIT)) / size,
        len(text.translate(None, _NOT_SIGN)) / size,
        len(set(words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        size / n,
        math.log1p(n / len(lines)),
        (text.count(b".") + text.count(b"!") + text.count(b"?")) / n,
        text.count(b"!") / n,
    ]


def metadata(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """The metadata view: buckets of language and source, and the stated size, -1 if there is none."""
    number = lambda kind, x: zlib.crc32(f"{kind} {x}".encode()) % BUCKETS
    return [number(0, lang), number(1, source), -1 if n_chars is None else max(0, n_chars)]


class View:
    """Logistic model over one-hot columns, and its calibration."""

    def __init__(self, width: int):
        self.w, self.slope, self.shift = np.zeros(width + 1), 1.0, 0.0

    def margin(self, rows: np.ndarray) -> np.ndarray:
        return self.w[rows].sum(1) + self.w[-1]

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated log-odds."""
        return self.slope * self.margin(rows) + self.shift

    def fit(self, rows: np.ndarray, y: np.ndarray, steps: int = 300, ridge: float = 1.0) -> None:
        w, n = np.zeros_like(self.w), len(y)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, steps + 1):
            p = 1 / (1 + np.exp(-(w[rows].sum(1) + w[-1])))
            e = y - p
            grad = np.bincount(rows.ravel(), np.repeat(e, rows.shape[1]), len(w)) - ridge * w
            grad[-1] = e.sum()
            m, v = 0.9 * m + 0.1 * grad / n, 0.999 * v + 0.001 * (grad / n) ** 2
            w = w + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        self.w = w

    def calibrate(self, rows: np.ndarray, y: np.ndarray, prior: float, steps: int = 60) -> None:
        """Newton steps for slope and shift, with targets drawn in as Platt has it. A slope below zero means no knowledge."""
        x = self.margin(rows)
        n1 = y.sum()
        t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
        a, b = 1.0, 0.0
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
            s = p * (1 - p)
            g = np.array([(x * (t - p)).sum(), (t - p).sum()])
            h = np.array([[(s * x * x).sum() + 1e-3, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -2, 2)
        self.slope, self.shift = (a, b) if a > 0 else (0.0, prior)


class Model:
    """Both views, the prior, the bins of the measures and sizes, and the views' weights in the combination.

    report: for each round how many pseudo-labels of each kind each view handed over, and how well both did on the rows kept out.
    """

    def __init__(self, prior: float, edges: np.ndarray | None = None, sizes: np.ndarray | None = None):
        self.prior, self.edges, self.sizes = prior, edges, sizes
        self.views: tuple[View, View] | None = None
        self.knows = (False, False)
        self.weights = (1.0, 1.0)
        self.report: list[dict] = []

    def bins(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Column numbers of both views."""
        first = np.stack([np.searchsorted(e, c, side="left") + i * (BINS + 1) for i, (e, c) in enumerate(zip(self.edges, content.T, strict=True))], 1)
        lang, source, size = meta.T
        fine = np.where(size < 0, SIZES + 1, np.searchsorted(self.sizes, size, side="left"))
        coarse = np.where(size < 0, COARSE, np.minimum(fine * COARSE // (SIZES + 1), COARSE - 1))
        cells = (lang, source, fine, (31 * lang + coarse) % BUCKETS, (31 * source + coarse) % BUCKETS, (31 * lang + source) % BUCKETS)
        return first, np.stack([c + i * BUCKETS for i, c in enumerate(cells)], 1)

    def views_of(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log-odds of the content view and of the metadata view."""
        return tuple(v.odds(x) for v, x in zip(self.views, self.bins(content, meta), strict=True))

    def odds(self, content: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log-odds of the content view, the metadata view, and both together."""
        if self.views is None:
            same = np.full(len(content), self.prior)
            return same, same, same
        a, b = self.views_of(content, meta)
        return a, b, self.prior + self.weights[0] * (a - self.prior) + self.weights[1] * (b - self.prior)

    def combine(self, a: np.ndarray, b: np.ndarray, y: np.ndarray, pull: float = 5.0, steps: int = 40) -> None:
        """The views' weights by Newton steps, drawn to (1, 1) and not below zero."""
        x, w, start = np.stack([a, b], 1) - self.prior, np.ones(2), np.ones(2)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(self.prior + x @ w, -35, 35)))
            h = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(2)
            w = np.maximum(w + np.clip(np.linalg.solve(h, x.T @ (y - p) - pull * (w - start)), -0.5, 0.5), 0)
        self.weights = (float(w[0]), float(w[1]))

    def sure(self) -> tuple[float, float]:
        """How certain a view must be of label 0 and of label 1."""
        p = 1 / (1 + math.exp(-self.prior))
        return max(LEAST_SURE, 1 - p / 2), max(LEAST_SURE, 1 - (1 - p) / 2)


def offers(model: Model, content: np.ndarray, meta: np.ndarray, h: np.ndarray, taken: tuple[np.ndarray, np.ndarray], most: int) -> tuple[np.ndarray, ...]:
    """(row, view, label, certainty) of the rows that each view is surest of, at most `most` for each label; taken: h of those that it has handed over already."""
    out = []
    for k, odds in enumerate(model.views_of(content, meta)):
        if not model.knows[k]:
            continue
        p = 1 / (1 + np.exp(-np.clip(odds, -35, 35)))
        fresh = ~np.isin(h, taken[k])
        for label, least in enumerate(model.sure()):
            certainty = p if label else 1 - p
            at = np.flatnonzero(fresh & (certainty >= least))
            at = at[np.lexsort((h[at], -certainty[at]))][:most]
            out.append((at, np.full(len(at), k), np.full(len(at), label), certainty[at]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


Pool = Callable[[Model, tuple[np.ndarray, np.ndarray], tuple[int, int]], tuple[np.ndarray, ...]]


def fit(content: np.ndarray, meta: np.ndarray, y: np.ndarray, pool: Pool | None = None, rounds: int = ROUNDS, given: float = GIVEN) -> Model:
    """y: 0 or 1. pool: hands over (h, view, label, certainty, content, meta) of the surest rows, given a model, what each view has handed over, and how many of labels 0 and 1."""
    n1, n = int((y == 1).sum()), len(y)
    prior = math.log((n1 + 1) / (n - n1 + 1)) if n else 35.0
    if n < 20 or not 0 < n1 < n:
        return Model(prior)
    at = lambda x, k: np.quantile(x, np.linspace(0, 1, k + 2)[1:-1], axis=0)
    model = Model(prior, at(content, BINS).T, at(meta[:, 2], SIZES))
    rows = model.bins(content, meta)
    held = np.arange(n) % 4 == 0
    counts = (max(1, round(given * (n - n1))), max(1, round(given * n1)))
    taught: list[list] = [[], []]  # (columns, pseudo-label) for each view
    taken = [np.empty(0, np.int64), np.empty(0, np.int64)]
    model.views = (View(MEASURES * (BINS + 1)), View(6 * BUCKETS))
    share = 1 / (1 + math.exp(-prior))
    truth = y[held].astype(float)
    constant = float(truth.sum() * math.log(share) + (1 - truth).sum() * math.log(1 - share))
    known = [-math.inf, -math.inf]  # log-likelihood of each view on the rows kept out
    for r in range(rounds + 1):
        for k, (view, x, own) in enumerate(zip(model.views, rows, taught, strict=True)):
            extra, before = ([e[0] for e in own], [e[1] for e in own]), (view.w, view.slope, view.shift)
            view.fit(np.concatenate([x[~held], *extra[0]]), np.concatenate([y[~held].astype(float), *extra[1]]))
            view.calibrate(x[held], truth, prior)
            odds = view.odds(x[held])
            now = float((truth * odds - np.logaddexp(0, odds)).sum())
            if now < known[k] - WORSE:  # the last lesson misled: the view forgets it
                view.w, view.slope, view.shift = before
                own.pop()
                model.report[-1][("content", "metadata")[k] + " forgot"] = True
            else:
                known[k] = now
        model.knows = tuple(x - constant > 2 for x in known)  # more than calibration's two parameters explain
        a, b = (v.odds(x[held]) for v, x in zip(model.views, rows, strict=True))
        model.combine(a, b, y[held])
        right = lambda odds: float(((odds > 0) == (y[held] > 0)).mean())
        both = model.odds(content[held], meta[held])[2]
        model.report.append({"round": r, "content": right(a), "metadata": right(b), "both": right(both)})
        if r == rounds or pool is None:
            break
        h, view, label, certainty, c, m = pool(model, tuple(taken), counts)
        cells = model.bins(c, m) if len(h) else rows
        for k in (0, 1):
            mine = np.flatnonzero(view == k)
            taken[k] = np.concatenate([taken[k], h[mine]])
            taught[1 - k].append((cells[1 - k][mine], np.where(label[mine] > 0, certainty[mine], 1 - certainty[mine])))
            model.report[-1][("content", "metadata")[k] + " gave"] = (int((label[mine] == 0).sum()), int((label[mine] == 1).sum()))
    return model


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    content = np.array([measures(t) for t in text_bytes(batch.column("text"))], float).reshape(-1, MEASURES)
    meta = np.array([metadata(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")), strict=True)], np.int64).reshape(-1, 3)
    return content, meta


_FEATURES = "doc_id bigint, content array<double>, meta array<bigint>"


def _lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))


def _matrix(column, width: int, kind) -> np.ndarray:
    return np.asarray(pa.compute.list_flatten(column), kind).reshape(-1, width)


def features(docs: DataFrame) -> DataFrame:
    """doc_id and both views of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            content, meta = _views(batch)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), _lists(content), _lists(meta)], names=["doc_id", "content", "meta"])

    return docs.select("doc_id", "text", "lang", "source", "n_chars").mapInArrow(run, _FEATURES)


def pool_of(free: DataFrame) -> Pool:
    """The pool of a stable table (h, content, meta) of any size: every row is looked at in each round, and no task hands over more than is asked."""
    shape = "h bigint, view int, label int, certainty double, content array<double>, meta array<bigint>"
    names = [x.split()[0] for x in shape.split(", ")]
    salts = max(1, int(math.sqrt(free.rdd.getNumPartitions())))

    def ask(model: Model, taken: tuple[np.ndarray, np.ndarray], counts: tuple[int, int]) -> tuple[np.ndarray, ...]:
        most = max(counts)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                content, meta, h = _matrix(batch.column("content"), MEASURES, float), _matrix(batch.column("meta"), 3, np.int64), batch.column("h").to_numpy()
                at, view, label, certainty = offers(model, content, meta, h, taken, most)
                columns = [pa.array(h[at]), pa.array(view, pa.int32()), pa.array(label, pa.int32()), pa.array(certainty), _lists(content[at]), _lists(meta[at])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

        # The best of each salt, then of all salts: what one task ranks grows with the root of the number of partitions.
        salted = Window.partitionBy("view", "label", F.pmod("h", F.lit(salts))).orderBy(F.desc("certainty"), "h")
        few = free.mapInArrow(run, shape).withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= most).drop("rank")
        rank = Window.partitionBy("view", "label").orderBy(F.desc("certainty"), "h")
        best = few.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= most)
        best = best.where(F.col("rank") <= F.when(F.col("label") == 0, counts[0]).otherwise(counts[1]))
        t = best.orderBy("view", "label", "rank").select(*names).toArrow().combine_chunks()  # at most four times `most` rows
        plain = [t.column(c).to_numpy() for c in names[:4]]
        return *plain, _matrix(t.column("content"), MEASURES, float), _matrix(t.column("meta"), 3, np.int64)

    return ask


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = FIT_ROWS, rounds: int = ROUNDS) -> Model:
    made = written(features(docs), "features")
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y"))
    chosen = lowest_hashes(known, "doc_id", most)
    one = made.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("content", "meta", "y")).alias("x"))  # at most `most` ids
    rows = one.select("doc_id", "x.*").orderBy("doc_id").toArrow().combine_chunks()
    # Of equal features the hash of one, so a group of copies is one row; a null id is no label's.
    free = made.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").groupBy("content", "meta").agg(F.count("*").alias("copies"))
    free = written(free.select(F.xxhash64("content", "meta").alias("h"), "content", "meta"), "unlabelled")
    model = fit(_matrix(rows.column("content"), MEASURES, float), _matrix(rows.column("meta"), 3, np.int64), rows.column("y").to_numpy(), pool_of(free), rounds)
    discard(made, free)
    return model


RESULTS = ("content_score", "metadata_score", "score", "kept")


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """docs with the probability of good quality by each view and by both, and kept."""
    names = [c for c in docs.columns if c not in RESULTS]
    schema = docs.select(*names).schema.add("content_score", "double").add("metadata_score", "double").add("score", "double").add("kept", "boolean")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            content, meta = _views(batch)
            found = [1 / (1 + np.exp(-np.clip(o, -35, 35))) for o in model.odds(content, meta)]
            columns = [*(batch.column(c) for c in names), *map(pa.array, found), pa.array(found[2] >= keep)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *RESULTS])

    return docs.select(*names).mapInArrow(run, schema)
