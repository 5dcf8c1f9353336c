"""Language detection by character n-grams: fitted on documents whose language is known, applied to whole texts.

Texts are prepared by built-in functions; a task then looks up the n-grams of a batch in a table of their log-probabilities in every language and sums by text, so no n-gram becomes a row and detection shuffles
nothing. A model of more than ``ENTRIES`` probabilities is applied in slices, one after the other. Fitting shuffles the kinds of n-grams that tasks have counted.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ..tables import discard, written

SIZE = 3
#: Log-probabilities that are sent to the tasks at once.
ENTRIES = 1 << 20
#: Characters whose n-grams a task looks up at once.
PIECE = 1 << 20


def letters(text: Column) -> Column:
    """The text, lower-cased, whatever isn't a letter or a mark as one blank, and a blank at either end."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\s\d\p{P}\p{S}]+", " "), F.lit(" "))
    return F.regexp_replace(spaced, " +", " ")


def _pieces(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Rows and parts of their texts, about PIECE characters together. Neighbouring parts of a longer text share size - 1 characters, so each n-gram is in one of them."""
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts.to_pylist()):
        for start in range(0, max(1, len(text) - size + 1), PIECE):
            rows.append(row)
            parts.append(text[start : start + PIECE + size - 1])
            held += len(parts[-1])
            if held >= PIECE:
                yield np.array(rows), parts
                rows, parts, held = [], [], 0
    if parts:
        yield np.array(rows), parts


def _codes(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of texts as numbers of 21 bits a character, and the place of each one's text. A text of fewer characters has none."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.array(np.frombuffer("".join([*texts, " "]).encode("utf-32-le", "surrogatepass"), "<u4")[:-1], np.int64)
    row = np.repeat(np.arange(len(texts)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))
    at = np.flatnonzero(left >= size)
    code = np.zeros(len(at), np.int64)
    for k in range(size):
        code = code << 21 | points[at + k]
    return code, row[at]


def _gram(code: int, size: int) -> str:
    return "".join(chr(code >> 21 * k & 0x1FFFFF) for k in range(size - 1, -1, -1))


def _counts(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(lang, gram, n), summed in tasks first, so that what is shuffled are a task's kinds of n-grams and not its n-grams."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            of = langs.indices.to_numpy()
            for rows, parts in _pieces(batch.column("letters"), size):
                code, row = _codes(parts, size)
                lang = of[rows[row]]
                for k in np.unique(lang):
                    name = langs.dictionary[int(k)].as_py()
                    kinds, n = np.unique(code[lang == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(kinds), pa.string()), pa.array([_gram(int(c), size) for c in kinds], pa.string()), pa.array(n)], names=["lang", "gram", "n"])

    return docs.select("lang", letters(F.col("text")).alias("letters")).mapInArrow(make, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, languages: int | None = None, most: int | None = None) -> DataFrame:
    """(gram, lang, weight): the natural log of (n + 0.5) / (total + 0.5 * (kinds + 1)), for each gram in each language. docs: text and lang; rows without a language teach nothing.

    languages: only of so many, those of most documents; most: only the grams that a language has most often, so many of each. Without them, all.
    """
    known = docs.where("lang IS NOT NULL").select("lang", "text")
    if languages is not None:
        chosen = known.groupBy("lang").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "lang").limit(languages).select("lang")
        known = known.join(F.broadcast(chosen), "lang", "left_semi")
    counts = written(_counts(known), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    kinds = counts.select("gram").distinct().count()
    kept = counts
    if most is not None:
        order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
        kept = counts.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most)
    every = kept.select("gram").distinct().join(F.broadcast(totals)).join(counts, ["lang", "gram"], "left")
    weight = F.log((F.coalesce("n", F.lit(0)) + 0.5) / (F.col("total") + 0.5 * (kinds + 1)))
    return written(every.select("gram", "lang", weight.alias("weight")), "language-model")


def _sums(rows: pa.Table, langs: list[str]):
    """Adds to the sums of texts (a number for each language, and how many n-grams were known) what the n-grams of a slice of the model give."""
    grams = rows.column("gram").to_pylist()
    size = max(map(len, grams), default=SIZE)
    code = np.array([sum(ord(c) << 21 * (size - 1 - k) for k, c in enumerate(g)) for g in grams], np.int64)
    known, at = np.unique(code, return_inverse=True)
    weights = np.zeros((len(langs), len(known)))
    place = {x: k for k, x in enumerate(langs)}
    weights[[place[x] for x in rows.column("lang").to_pylist()], at] = rows.column("weight").to_numpy()
    held = SparkSession.active().sparkContext.broadcast((known, weights))

    def add(texts: pa.Array, sums: np.ndarray) -> np.ndarray:
        known, weights = held.value
        for own, parts in _pieces(texts, size) if len(known) else ():
            code, row = _codes(parts, size)
            near = np.minimum(np.searchsorted(known, code), len(known) - 1)
            hit = known[near] == code
            near, row = near[hit], row[hit]
            for k in range(len(langs)):
                np.add.at(sums[:, k], own, np.bincount(row, weights[k, near], len(parts)))
            np.add.at(sums[:, -1], own, np.bincount(row, minlength=len(parts)))
        return sums

    return add


def detect(docs: DataFrame, model: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, detected): the language in which the text is likeliest, the smallest name among equals; null for texts without a known gram. key tells rows apart; no model knows no text."""
    langs = sorted(x.lang for x in model.select("lang").distinct().collect())
    slices = -(-model.count() // ENTRIES) or 1
    part = F.pmod(F.xxhash64("gram"), F.lit(slices))
    kind = docs.select(key).schema
    rows = docs.select(key, letters(F.col("text")).alias("letters"))

    def before(batch: pa.RecordBatch) -> np.ndarray:
        if "sums" not in batch.schema.names:
            return np.zeros((batch.num_rows, len(langs) + 1))
        return np.array(batch.column("sums").flatten().to_numpy()).reshape(batch.num_rows, len(langs) + 1)

    for k in range(slices - 1):
        add = _sums(model.where(part == k).toArrow(), langs)

        def carry(batches: Iterable[pa.RecordBatch], add=add) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sums = add(batch.column("letters"), before(batch))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(sums.ravel()), sums.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("letters"), lists], names=[key, "letters", "sums"])

        done = rows
        rows = written(rows.mapInArrow(carry, StructType([*kind.fields, StructField("letters", StringType()), StructField("sums", ArrayType(DoubleType()))])), "language-sums")
        if k:
            discard(done)
    last = _sums(model.where(part == slices - 1).toArrow(), langs)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = last(batch.column("letters"), before(batch))
            best = np.round(sums[:, :-1], 6).argmax(1).tolist() if langs else []
            found = [langs[b] if x else None for b, x in zip(best, sums[:, -1] > 0, strict=True)] if langs else [None] * batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(found, pa.string())], names=[key, "detected"])

    return rows.mapInArrow(make, StructType([*kind.fields, StructField("detected", StringType())]))


def english_only(docs: DataFrame, model: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs in English, and those whose language isn't known."""
    return docs.join(detect(docs, model, key).where("detected <> 'en'").select(key), key, "left_anti")
