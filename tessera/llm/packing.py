"""Best-fit packing of tokenized documents into sequences of bounded length, with large-item matching.

A document is its token ids and an end id. Longer ones than the capacity are cut into full pieces, the first of which may
be shorter. How pieces are packed depends on their lengths alone, so the plan is made from the histogram of lengths, at
most ``capacity`` rows, however many documents there are: lengths above a third of the capacity share a sequence at most
in pairs, matched greedily from the largest down, each with the largest partner that fits; shorter ones then go, largest
first, to the smallest gap that holds them, and to new sequences where none does. Bins that are filled alike are one
entry of the plan with a count, so the plan has a few thousand rows at any size. Pieces find their place by their rank
among pieces of equal length; ranks are counted in two levels (counts for each salted bucket, then a rank in each bucket), so a
length that a third of all pieces share is spread over many tasks.

Defined cases: a null text counts as empty, and an empty text is a document of the end id alone; a null id is kept as
null; equal texts are packed like different ones; an empty table gives no rows; other columns are ignored. The tokenizer's
special string in a text becomes its special id, as the tokenizer itself has it by default. A very long text is one row in memory, with some forty bytes for each of its ids while it
is cut; white space or a word of any length is encoded like any other.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions_for, slices, written

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_ENCODERS: dict[int, object] = {}


def _encoder(content: str):
    """The byte-level BPE of a tokenizers file's content, run by tiktoken, which gives equal ids in a quarter of the time."""
    key = zlib.crc32(content.encode())
    if key not in _ENCODERS:
        import json

        import tiktoken

        spec = json.loads(content)
        split = spec["pre_tokenizer"]
        if split["type"] != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("the tokenizer file must split by the byte-level pattern and change no text before")
        to_byte = {c: b for b, c in byte_alphabet().items()}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in {t["content"] for t in spec["added_tokens"]}}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        _ENCODERS[key] = Encoder(*(tiktoken.Encoding(f"{key} {pattern}", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special) for pattern in (PRETOKENS, r"\s+")), set(special))
    return _ENCODERS[key]


class Encoder:
    """Ids of whole texts. The pattern keeps a state for each character of white space, which a long run exhausts; such a run, less its last character if something follows, is one
    pre-token in any case, so it is cut out and encoded as one."""

    def __init__(self, encoding, blank, special: set[str]):
        self.encoding, self.blank, self.special = encoding, blank, special

    def _part(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special=self.special, disallowed_special=())

    def encode(self, text: str) -> list[int]:
        if len(text) < LONG_BLANK:
            return self._part(text)
        ids, at = [], 0
        for run in _LONG_RUNS(text):
            start, end = run.span()
            if end < len(text) and not any(text.startswith(t, end) for t in self.special):
                end -= 1
            ids += self._part(text[at:start])
            ids += self.blank.encode_ordinary(text[start:end])
            at = end
        return ids + self._part(text[at:])


#: Runs of white space from this length on are encoded apart.
LONG_BLANK = 10_000
_LONG_RUNS = regex.compile(r"\s{%d,}" % LONG_BLANK).finditer

#: Fixed value: how the byte-level pre-tokenizer splits text; tokenizer files name it and don't hold it.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in out]
    return out | {b: chr(256 + i) for i, b in enumerate(rest)}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    head = n % capacity if n > capacity else n
    edges = ([head] if head else []) + [capacity] * ((n - head) // capacity)
    starts = np.cumsum([0, *edges])
    return [(int(s), length) for s, length in zip(starts, edges, strict=False)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32. The tokenizer file's content is sent to the tasks."""
    with open(tokenizer_path, encoding="utf-8") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        for batch in slices(batches, "text"):
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encoder.encode(text) if text else []
                ids.append(end_id)
                packed = np.array(ids, dtype="<u4").data
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    for column, value in zip(out, (doc_id, k, start, length, zlib.crc32(packed[start : start + length])), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(encode, PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Entries (length, first rank, bins, pieces in each bin, first sequence, offset) that place counts[length] pieces.

    Ranks of a length are used up in order, so the entries of a length cover its ranks without gaps.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # gap: groups of (bins, contents as (length, times))
    gaps: list[int] = []  # the keys of bins, ascending

    def put(gap: int, count: int, content: list[tuple[int, int]]) -> None:
        if gap not in bins:
            gaps.insert(bisect_left(gaps, gap), gap)
            bins[gap] = []
        bins[gap].append((count, content))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        top = large[-1]
        k = bisect_left(large, capacity - top + 1) - 1
        if k < 0:
            put(capacity - top, left.pop(top), [(top, 1)])
            large.pop()
            continue
        mate = large[k]
        pairs = left[top] // 2 if mate == top else min(left[top], left[mate])
        if mate == top:
            if pairs:
                put(capacity - 2 * top, pairs, [(top, 2)])
            left[top] -= 2 * pairs
            if left[top]:  # one is over: the next smaller one that is there goes with it
                if k > 0:
                    put(capacity - top - large[k - 1], 1, [(top, 1), (large[k - 1], 1)])
                    left[large[k - 1]] -= 1
                else:
                    put(capacity - top, 1, [(top, 1)])
                left[top] = 0
        else:
            put(capacity - top - mate, pairs, [(top, 1), (mate, 1)])
            left[top] -= pairs
            left[mate] -= pairs
        large = [n for n in large if left[n]]
    for n in sorted((n for n in left if 3 * n <= capacity and left[n]), reverse=True):
        c = left[n]
        while c:
            i = bisect_left(gaps, n)
            if i == len(gaps):
                k = capacity // n
                if c >= k:
                    put(capacity - k * n, c // k, [(n, k)])
                if c % k:
                    put(capacity - c % k * n, 1, [(n, c % k)])
                break
            gap = gaps[i]
            count, content = bins[gap].pop()
            if not bins[gap]:
                del bins[gap], gaps[i]
            k = gap // n
            full = min(count, c // k)
            if full:
                put(gap - k * n, full, [*content, (n, k)])
                c -= full * k
            if full < count:
                rest = count - full
                if 0 < c < k:
                    put(gap - c * n, 1, [*content, (n, c)])
                    rest, c = rest - 1, 0
                if rest:
                    put(gap, rest, content)
    out, sequence, rank = [], 0, dict.fromkeys(counts, 0)
    for gap in gaps:
        for count, content in bins[gap]:
            offset = 0
            for n, k in content:
                out.append((n, rank[n], count, k, sequence, offset))
                rank[n] += count * k
                offset += n * k
            sequence += count
    return out


def pack(cuts: DataFrame, capacity: int = CAPACITY, per_task: int = 100_000) -> DataFrame:
    """cuts (a stable table with row, a number of each row's own, and length) with sequence_id and offset. Rows are dealt out by their numbers, so that no id is a hot key."""
    spark = cuts.sparkSession
    counted = cuts.groupBy("length").count().collect()  # at most `capacity` rows
    counts = {r["length"]: r["count"] for r in counted}
    buckets = partitions_for(spark, sum(counts.values()), per_task)
    bucket = F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int")
    salted = cuts.withColumn("_bucket", bucket)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy("length", "_bucket").count().select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy("row")
    ranked = salted.withColumn("_in", F.row_number().over(within) - 1).join(sizes, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_in"))
    entries = spark.createDataFrame(plan(counts, capacity) or [(0, 0, 0, 1, 0, 0)], "length bigint, _first bigint, _bins bigint, _times bigint, _sequence bigint, _offset bigint")
    at = F.col("_rank") - F.col("_first")
    placed = ranked.join(F.broadcast(entries), "length").where((at >= 0) & (at < F.col("_bins") * F.col("_times")))
    return placed.select(
        *[c for c in cuts.columns if c not in ("row", "sequence_id", "offset")],
        (F.col("_sequence") + F.floor(at / F.col("_times"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + at % F.col("_times") * F.col("length")).cast("long").alias("offset"),
    )


def best_fit_packing(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of docs with their sequence and offset. Tokenizing happens once; its rows go to a table in the shared folder."""
    return pack(written(pieces(docs, tokenizer_path, capacity, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces"), capacity)
