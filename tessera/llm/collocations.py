"""Phrase collocations by position bitmaps.

Texts of a language are cut into shards of a few megabytes. In a shard each word has a bitmap of the positions at which it stands, compressed to its non-empty blocks of 16
positions; one position stays empty between pieces, so nothing reaches across a piece. The bitmap of a phrase with one more word is the bitmap of the phrase, shifted by one, AND
the bitmap of the word, and how often it occurs is the number of bits set. Phrases grow depth-first: those of some first words are extended to full length before those of the next
are begun, all blocks of them in one vectorized step, where a block is only held against words that stand in it. Sums over shards are the frequencies.

Passes go over the written shards, one for each size. The first sums words. Those for phrases of two words and more, but the longest, sum what grows to that size by a hash, which can only overstate a count; hashes are summed in a task and sent by bucket, as arrays; a phrase is
counted if its first and its last words, less one, may be frequent. The last pass sums the phrases that may be frequent as they are. What may be frequent is a bit table of fixed size (``BITS``) for each size, so what is sent
to the tasks doesn't grow; a bit that is set for another phrase costs work and changes no result, since the frequencies that count are exact sums. With full tables a pass makes at most a row for each word
of the corpus and size. What a task has counted is summed before it leaves, a row for each bucket of phrases, and these rows are summed as they come, bucket after bucket, so the rows go by the tasks
and by the phrases that are frequent. The counts in them are at most as many as the occurrences: the more a corpus has, the more of its phrases reach a fixed frequency, and the more tasks hold each. Cuts, drops and scores are joins of frequencies; scores are integer divisions of decimals of 38 digits.

Defined cases: a null text counts as empty; a null language is ``und``, together with rows that say so; rows count as often as they stand in the table; a text without pieces or
a piece of one word adds to n alone; equal scores go by frequency and then by the bytes of the phrase; an empty table gives no rows; a very long text is cut at its
piece edges, and only a single piece longer than a shard makes a longer one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..tables import discard
from .common import slices, small_batches, text_bytes, written

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bytes of text in a shard, and those that wait in a task for theirs to fill.
SHARD_BYTES = 2 << 20
WAITING_BYTES = 8 << 20
#: Bytes of shards that a task holds while it writes or reads them.
GROUP_BYTES = 8 << 20
#: Bytes of a batch of rows, from which it is sent to Python: a shard, or many rows of sums.
BATCH_BYTES = 1 << 20
#: Block rows that are extended together.
ROWS = 1 << 16
#: The bit tables have 2 ** BITS bits; phrases are counted by hashes of HASH_BITS bits.
BITS, HASH_BITS = 26, 44
#: Hashes of phrases that a task holds until it sums them.
HELD = 2_000_000
#: Phrases that a task holds until it sums them, and the buckets by which their sums leave it.
HELD_PHRASES, BUCKETS = 500_000, 4096
SHARD = "lang string, n bigint, words array<string>, counts array<bigint>, blocks_of array<int>, blocks binary, bits binary"
_WIDTH = 16
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(29))


def tokens(buffer: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of lower-cased text, and for each word of the text its number and its position; positions skip one between pieces."""
    data = np.frombuffer(buffer.lower(), np.uint8)
    kind = _KIND[data]
    inside = kind == 0
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    breaks = np.cumsum(kind == 2, dtype=np.int32)[starts]
    position = np.arange(len(starts), dtype=np.int32) + np.cumsum(np.diff(breaks, prepend=0) != 0, dtype=np.int32)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    encoded = words.dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False), position


def shard(lang: str, buffer: bytes) -> pa.RecordBatch | None:
    """A row of SHARD: the bitmaps of the buffer's words, word after word, as block numbers (each less the one before) and 16 bits for each block."""
    words, number, position = tokens(buffer)
    if not len(number):
        return None
    order = np.argsort(number, kind="stable")
    w, p = number[order], position[order]
    block, bit = p // _WIDTH, np.left_shift(1, p % _WIDTH).astype(np.uint16)
    first = np.flatnonzero(np.concatenate(([True], (w[1:] != w[:-1]) | (block[1:] != block[:-1]))))
    bits = np.bitwise_or.reduceat(bit, first)
    block = block[first]
    columns = [
        pa.array([lang], pa.string()), pa.array([len(number)], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string())),
        pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(np.bincount(number))),
        pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), pa.array(np.bincount(w[first]).astype(np.int32))),
        pa.array([np.diff(block, prepend=0).astype("<i4").tobytes()], pa.binary()), pa.array([bits.astype("<u2").tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "n", "words", "counts", "blocks_of", "blocks", "bits"])


def cuts(buffer: bytes, most: int) -> Iterator[bytes]:
    """The buffer in parts of about `most` bytes, cut after bytes that end a piece."""
    at = 0
    while len(buffer) - at > most:
        ends = np.flatnonzero(_KIND[np.frombuffer(buffer, np.uint8, most, at)] == 2)
        if len(ends):
            end = at + int(ends[-1]) + 1
        else:
            found = (np.flatnonzero(_KIND[np.frombuffer(buffer, np.uint8, min(most, len(buffer) - k), k)] == 2) + k for k in range(at + most, len(buffer), most))
            end = next((int(x[0]) + 1 for x in found if len(x)), len(buffer))
        yield buffer[at:end]
        at = end
    if at < len(buffer):
        yield buffer[at:]


def shards(docs: DataFrame, most: int = SHARD_BYTES, waiting: int = WAITING_BYTES) -> DataFrame:
    """The bitmaps of all texts, a row for each shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            del sizes[lang]
            for buffer in cuts(b"\n".join(parts.pop(lang)), 2 * most):
                if (row := shard(lang, buffer)) is not None:
                    yield row

        for batch in slices(batches, "text", 1 << 20):
            for lang, text in zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text")), strict=True):
                if text:
                    parts.setdefault(lang, []).append(text)
                    sizes[lang] = sizes.get(lang, 0) + len(text) + 1
                    if sizes[lang] >= most:
                        yield from flush(lang)
            while sum(sizes.values()) > waiting:
                yield from flush(max(sizes, key=sizes.__getitem__))
        for lang in list(parts):
            yield from flush(lang)

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, SHARD)


def word_hashes(lang: str, words: Iterable[str]) -> np.ndarray:
    head = xxhash.xxh64_intdigest(lang)
    return np.fromiter((xxhash.xxh64_intdigest(w, head) for w in words), np.uint64)


def joined_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word, of both hashes."""
    h = (a * _MIX[0] + b) * _MIX[1]
    return (h ^ h >> _MIX[2]) * _MIX[0]


def maybe(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of hashes are set; the table's size is a power of two."""
    bit = hashes >> np.uint64(65 - (64 * len(table)).bit_length())
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_table(hashed: DataFrame, column: str, bits: int = BITS):
    """A broadcast bit table of the hashes: words of 64 bits are put together by Spark, at most 2 ** (bits - 6) of them."""
    bit = hashed.select(F.shiftrightunsigned(column, 64 - bits).alias("bit"))
    rows = bit.groupBy(F.expr("shiftright(bit, 6)").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("set")).toArrow()
    table = np.zeros(1 << bits - 6, np.uint64)
    table[rows.column("at").to_numpy()] = rows.column("set").to_numpy().view(np.uint64)
    return hashed.sparkSession.sparkContext.broadcast(table)


class Bitmaps:
    """The bitmaps of a shard's words that may be frequent, by word and by block."""

    def __init__(self, row: dict, frequent: np.ndarray):
        self.words = row["words"]
        self.hashes = word_hashes(row["lang"], self.words)
        live = maybe(frequent, self.hashes)
        word = np.repeat(np.arange(len(self.words), dtype=np.int32), row["blocks_of"])
        keep = live[word]
        self.word = word[keep]
        self.block = np.cumsum(np.frombuffer(row["blocks"], "<i4"), dtype=np.int32)[keep]
        self.bits = np.frombuffer(row["bits"], "<u2")[keep]
        order = np.argsort(self.block, kind="stable")
        self.by_block = (self.word[order], self.bits[order])
        self.starts = np.searchsorted(self.block[order], np.arange((int(self.block.max()) if len(self.block) else 0) + 3)).astype(np.int32)

    def first_words(self) -> Iterator[tuple[int, int]]:
        """Ranges of rows that hold all blocks of some words, about ROWS of them."""
        ends = np.flatnonzero(np.diff(self.word, append=-1)) + 1
        at = 0
        while at < len(self.word):
            k = np.searchsorted(ends, at + ROWS, side="right") - 1
            end = int(ends[k]) if k >= 0 and ends[k] > at else int(ends[np.searchsorted(ends, at, side="right")])
            yield at, end
            at = end

    def extend(self, node: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bitmaps of all nodes, shifted by one and ANDed with each word of their blocks: node, word, block, bits of what isn't empty."""
        moved, over = bits << np.uint16(1), bits >> np.uint16(_WIDTH - 1)
        stay, carried = np.flatnonzero(moved), np.flatnonzero(over)
        node = np.concatenate((node[stay], node[carried]))
        block = np.concatenate((block[stay], block[carried] + 1))
        bits = np.concatenate((moved[stay], over[carried]))
        words, word_bits = self.by_block
        start = self.starts[block]
        many = self.starts[block + 1] - start
        row = np.repeat(np.arange(len(node), dtype=np.int32), many)
        at = np.arange(len(row), dtype=np.int32) + np.repeat(start - (np.cumsum(many, dtype=np.int32) - many), many)
        both = bits[row] & word_bits[at]
        hit = np.flatnonzero(both)
        row = row[hit]
        return node[row], words[at[hit]], block[row], both[hit]


def children(node: np.ndarray, word: np.ndarray, bits: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (node, word) with their popcounts, and the number of its pair for each row."""
    key, number = np.unique(node.astype(np.int64) * words + word, return_inverse=True)
    counts = np.bincount(number, weights=np.bitwise_count(bits), minlength=len(key)).astype(np.int64)
    return key // words, key % words, counts, number


def grown(maps: Bitmaps, tables: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Size, parent, last word, hash and count of phrases, depth-first from the first words.

    tables[k] has the hashes of phrases of k + 1 words that may be frequent. A phrase grows if it may be; one that is longer than the tables go is given if its first and its last words, less one, may be.
    Parents are numbers among the phrases given before it with one word less, or words.
    """
    for start, end in maps.first_words():
        node, block, bits = maps.word[start:end], maps.block[start:end], maps.bits[start:end]
        whole, rest = maps.hashes, np.zeros(len(maps.hashes), np.uint64)
        for size in range(2, longest + 1):
            node, word, block, bits = maps.extend(node, block, bits)
            parent, last, counts, node = children(node, word, bits, len(maps.words))
            hashes = joined_hashes(whole[parent], maps.hashes[last])
            ends = joined_hashes(rest[parent], maps.hashes[last]) if size > 2 else maps.hashes[last]
            live = maybe(tables[size - 1], hashes) if size <= len(tables) else maybe(tables[size - 2], ends)
            if not live.any():
                break
            number = np.cumsum(live) - 1
            keep = live[node]
            node, block, bits = number[node[keep]], block[keep], bits[keep]
            whole, rest = hashes[live], ends[live]
            yield size, parent[live], last[live], whole, counts[live]


def hashed_counts(row: dict, tables: list[np.ndarray], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and counts of a shard's phrases of one size, all of whose shorter ones may be frequent."""
    for of, _, _, hashes, counts in grown(Bitmaps(row, tables[0]), tables, size):
        if of == size:
            yield hashes, counts


def phrase_counts(row: dict, tables: list[np.ndarray], longest: int = LONGEST) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Sizes, phrases and counts of a shard's phrases that may be frequent."""
    maps = Bitmaps(row, tables[0])
    words = pa.array(maps.words, pa.large_string())
    before = words
    for size, parent, last, _, counts in grown(maps, tables, longest):
        before = words if size == 2 else before
        before = pa.compute.binary_join_element_wise(before.take(pa.array(parent)), words.take(pa.array(last)), pa.scalar(" ", pa.large_string()))
        yield size, before, counts


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in ("lang", "words", "blocks_of", "blocks", "bits")}
            yield {"lang": row["lang"].as_py(), "words": row["words"].as_py(), "blocks_of": row["blocks_of"].values.to_numpy(), "blocks": row["blocks"].as_py(), "bits": row["bits"].as_py()}


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of each one's counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def bucketed(held: list[tuple[np.ndarray, np.ndarray]], most: int) -> pa.RecordBatch:
    """A row for each bucket, by the bits of a hash above the lower 32, with the lower 32 of its hashes and their summed counts, at most `most`."""
    h, counts = summed(np.concatenate([h for h, _ in held]), np.concatenate([c for _, c in held]))
    bucket = (h >> np.uint64(32)).astype(np.int32)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(h) else np.empty(0, np.int64)
    edges = pa.array(np.append(first, len(h)).astype(np.int32))
    low, c = pa.array(h.astype(np.uint32).view(np.int32)), pa.array(np.minimum(counts, most).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), pa.ListArray.from_arrays(edges, low), pa.ListArray.from_arrays(edges, c)], names=["bucket", "low", "c"])


_COUNT = pa.struct([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("c", pa.int64())])


def folded(held: list[pa.Table]) -> pa.RecordBatch:
    """A row for each bucket, by a hash of the phrase, with its phrases and their summed counts. held: lang, phrase, size, c."""
    sums = pa.concat_tables(held).group_by(["lang", "phrase", "size"], use_threads=False).aggregate([("c", "sum")]).combine_chunks()
    bucket = np.fromiter((xxhash.xxh64_intdigest(p) % BUCKETS for p in sums.column("phrase").to_pylist()), np.int32, sums.num_rows)
    order = np.argsort(bucket, kind="stable")
    bucket, sums = bucket[order], sums.take(pa.array(order))
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
    columns = [sums.column(name).combine_chunks().cast(_COUNT.field(k).type) for k, name in enumerate(("lang", "phrase", "size", "c_sum"))]
    counts = pa.ListArray.from_arrays(pa.array(np.append(first, len(bucket)).astype(np.int32)), pa.StructArray.from_arrays(columns, fields=list(_COUNT)))
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), counts], names=["bucket", "counts"])


def met(batches: Iterable[pa.RecordBatch], least: int, most: int) -> Iterator[pa.RecordBatch]:
    """The sums of phrases that occur at least `least` times, of rows as `folded` makes them, sorted by bucket. Whenever `most` counts are held they are summed, and those of buckets that have ended leave."""
    held, n, after = [], 0, 0

    def summed_up(ended: int | None) -> tuple[pa.RecordBatch, pa.Table]:
        """Frequent phrases of all buckets, or of those before `ended`, and the sums of the others."""
        sums = pa.concat_tables(held).group_by(["bucket", "lang", "phrase", "size"], use_threads=False).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).combine_chunks()
        open_ = pa.compute.equal(sums["bucket"], pa.scalar(ended, pa.int32())).fill_null(False)
        done = sums.filter(pa.compute.and_(pa.compute.invert(open_), pa.compute.greater_equal(sums["c"], least))).combine_chunks()
        return pa.RecordBatch.from_arrays([done[k].combine_chunks() for k in _COUNT.names], names=["lang", "phrase", "size", "a"]), sums.filter(open_)

    for batch in batches:
        if not batch.num_rows:
            continue
        counts = batch.column("counts")
        bucket = np.repeat(batch.column("bucket").to_numpy(), pa.compute.list_value_length(counts).to_numpy(zero_copy_only=False))
        held.append(pa.Table.from_arrays([pa.array(bucket, pa.int32()), *counts.flatten().flatten()], names=["bucket", *_COUNT.names]))
        n += len(bucket)
        if n > 2 * max(most, after):
            out, rest = summed_up(batch.column("bucket")[-1].as_py())
            yield out
            held, n, after = [rest], len(rest), len(rest)
    if held:
        yield summed_up(None)[0]


def phrases(made: DataFrame, words: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = BITS) -> DataFrame:
    """lang, phrase, size, a: phrases of 2 to `longest` words that occur at least `least` times in all shards. words: lang and word of frequent words."""

    def of_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.concatenate([word_hashes(lang, [w]) for lang, w in zip(batch.column("lang").to_pylist(), batch.column("word").to_pylist(), strict=True)] or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["h"])

    tables = [bit_table(words.select("lang", "word").mapInArrow(of_words, "h bigint"), "h", bits)]
    shards_of = made.select("lang", "words", "blocks_of", "blocks", "bits")

    def hashed(known: list, size: int) -> DataFrame:
        """The hashes of phrases of one size that occur often enough. A task sums up to HELD of them before they leave it, as a row for each bucket with the lower halves and the counts; a count over `least` decides as well as `least`."""

        def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables_of, held, size_of = [t.value for t in known], [], 0
            for row in _rows(batches):
                for h, counts in hashed_counts(row, tables_of, size):
                    held.append((h >> np.uint64(64 - HASH_BITS), counts))
                    size_of += len(h)
                    if size_of > HELD:
                        yield bucketed(held, least)
                        held, size_of = [], 0
            if held:
                yield bucketed(held, least)

        made = shards_of.mapInArrow(runs, "bucket int, low array<int>, c array<int>").repartition("bucket")
        sums = made.select("bucket", F.inline(F.arrays_zip("low", "c"))).groupBy("bucket", "low").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
        return sums.select(F.expr("shiftleft(cast(bucket AS bigint), 32) | (cast(low AS bigint) & 4294967295L)").alias("h"))

    def counts_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables_of, held, n = [t.value for t in tables], [], 0
        for row in _rows(batches):
            for of, found, counts in phrase_counts(row, tables_of, longest):
                columns = [pa.array([row["lang"]] * len(found), pa.string()), found.cast(pa.string()), pa.array(np.full(len(found), of, np.int32)), pa.array(counts, pa.int64())]
                held.append(pa.Table.from_arrays(columns, names=["lang", "phrase", "size", "c"]))
                n += len(found)
                if n > HELD_PHRASES:
                    yield folded(held)
                    held, n = [], 0
        if held:
            yield folded(held)

    for size in range(2, longest):
        tables.append(bit_table(hashed(list(tables), size).select(F.shiftleft("h", 64 - HASH_BITS).alias("h")), "h", bits))
    counted = shards_of.mapInArrow(counts_of, "bucket int, counts array<struct<lang string, phrase string, size int, c bigint>>").repartition("bucket").sortWithinPartitions("bucket")
    return counted.mapInArrow(lambda batches: met(batches, least, HELD_PHRASES), "lang string, phrase string, size int, a bigint")


#: floor(1000 * a * n / (l * r)), exactly: counts have up to 18 digits, products up to 38.
SCORE = "(cast(a AS decimal(18,0)) * cast(n AS decimal(18,0)) * 1000) div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, salts: int = 32) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language."""
    spark = docs.sparkSession
    made = written(shards(docs), "bitmaps", GROUP_BYTES)
    totals = made.groupBy("lang").agg(F.sum("n").alias("n"))
    summed = made.select("lang", F.inline(F.arrays_zip("words", "counts")).alias("word", "c")).groupBy("lang", "word").agg(F.sum("c").alias("f"))
    words = written(summed.where(F.col("f") >= least), "frequent-words")
    totals = written(totals, "words-of-languages")
    with small_batches(spark, most_bytes=BATCH_BYTES):
        counted = written(phrases(made, words, least, longest), "phrases")
    discard(made)
    parts = F.split("phrase", " ")
    shorter = F.array(F.slice(parts, F.lit(1), F.col("size") - 1), F.slice(parts, F.lit(2), F.col("size") - 1))
    inside = counted.where("size > 2").select("lang", "a", F.explode(F.transform(shorter, lambda x: F.concat_ws(" ", x))).alias("phrase"))
    kept = counted.join(inside, ["lang", "phrase", "a"], "left_anti")
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumns({"left": F.concat_ws(" ", F.slice(parts, F.lit(1), F.col("k"))), "right": F.concat_ws(" ", F.slice(parts, F.col("k") + 1, F.col("size")))})
    known = words.select("lang", F.col("word").alias("part"), "f").unionByName(counted.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")))
    lefts, rights = (known.select("lang", F.col("part").alias(side), F.col("f").alias(side[0])) for side in ("left", "right"))
    joined = cut.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).join(totals, "lang")
    scored = joined.withColumn("score", F.expr(SCORE))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = lowest.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    first = salted.withColumn("_in", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).where(F.col("_in") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> str:
    """DuckDB SQL for the rows of the query."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = " UNION ALL ".join(f"SELECT lang, {k} AS size, array_to_string(w[i:i+{k - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM p WHERE len(w) >= {k})" for k in range(1, longest + 1))
    cut = " UNION ALL ".join(f"SELECT *, {k} AS k, array_to_string(string_split(phrase, ' ')[1:{k}], ' ') AS lp, array_to_string(string_split(phrase, ' ')[{k + 1}:], ' ') AS rp FROM kept WHERE size > {k}" for k in range(1, longest))
    return f"""
    WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda x: x <> '') AS w FROM t),
    f AS (SELECT lang, size, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
    c AS (SELECT lang, size, phrase, f AS a FROM f WHERE size > 1 AND f >= {least}),
    kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.lang = c.lang AND d.size > c.size AND 100 * d.a >= 100 * c.a AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
    cuts AS ({cut}),
    s AS (SELECT lang, cuts.phrase, a, l.f AS l, r.f AS r, n, k, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
          FROM cuts JOIN totals USING (lang) JOIN f l USING (lang) JOIN f r USING (lang) WHERE l.phrase = lp AND r.phrase = rp),
    one AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM s),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM one WHERE o = 1)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {top}"""
