"""Long repeats across a corpus, found and removed by a run-length index over anchored contexts.

A string of ``length`` bytes that occurs twice has the same smallest k-gram hash at both places, so occurrences of equal
strings meet at equal anchors, and only a few bytes in a hundred are anchors. The context of an anchor is every string of
the given length around it.

1. Anchors are dealt out by their k-gram, sorted, and streamed. Of anchors with equal contexts the first stands for all;
   the contexts of the others are repeats as a whole. Slices of input fold equal contexts before the shuffle, and a task
   holds one row at a time, so a passage that every document has costs one row for each slice.
2. First contexts whose k-gram has other contexts too are at the edges of repeats. Their bytes are fetched and dealt out by
   k-gram; they are cut to what they share with others of the k-gram, equal ones are folded, and the rest is indexed in buckets of bounded size: the bucket's Burrows-Wheeler transform is run-compressed, suffix positions
   and common prefixes are sampled at the run heads only, and matching statistics are streamed over the text from these
   samples (between samples, phi moves by one and the common prefix falls by one). Where a match of at least ``length``
   bytes has an occurrence with a smaller document, or an earlier start in the same one, it is marked.
3. A k-gram with more contexts than a bucket takes (``hot``) is resolved exactly, window by window: each of its windows
   goes through the first step as a context of its own.

Defined cases: a null text counts as empty; texts shorter than ``length`` keep all their bytes; rows that repeat both id and
text are one document and get equal results; rows that share an id but not their text are ordered by the text's crc32; null ids
come last; an empty table gives no rows; other columns are ignored by ``repeats`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import partitions_for, slices, small_batches, text_bytes, written

LENGTH = 100
GRAM = 32
#: A k-gram with more contexts than this is resolved window by window; buckets hold about this many bytes.
HOT = 10_000
BUCKET_BYTES = 1 << 20
MOST_HOT = 50_000
#: Longer runs of bytes are searched for anchors in parts, which overlap by a window.
PART_BYTES = 4 << 20
NULL_ID = (1 << 63) - 1

_ANCHOR = "m bigint, c bigint, doc bigint, tag bigint, at bigint, lo bigint, hi bigint, more boolean"
_NAMES = ["m", "c", "doc", "tag", "at", "lo", "hi", "more"]


def _rows(m, c, doc, tag, at, lo, hi, more) -> pa.RecordBatch:
    n = len(doc)
    columns = [pa.array(x, pa.int64()) if x is not None else pa.nulls(n, pa.int64()) for x in (m, c, doc, tag, at, lo, hi)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(more, pa.bool_())], names=_NAMES)


def document_key() -> list[Column]:
    """doc and tag: what tells documents apart and orders them. See tag_of."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    tag = F.shiftleft(F.crc32(data), 30).bitwiseOR(F.xxhash64(data).bitwiseAND(F.lit((1 << 30) - 1)))
    return [F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).alias("doc"), tag.alias("tag")]


def tag_of(text: bytes) -> int:
    """crc32 of the text, which orders texts of one id, and 30 bits of XXH64, so that texts without ids are told apart, too."""
    return zlib.crc32(text) << 30 | xxhash.xxh64_intdigest(text, 42) & (1 << 30) - 1


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best of each run of `width` values, by doubling."""
    out, span = values, 1
    while 2 * span <= width:
        out = best(out[:-span], out[span:])
        span *= 2
    return best(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A mixed 64-bit hash of the bytes at every position, gram a power of two. Depends on these bytes alone."""
    h = data.astype(np.uint64) + np.uint64(1)
    span, factor = 1, 0x9E3779B97F4A7C15
    while span < gram:
        h = h[:-span] * np.uint64(factor) + h[span:]
        factor = factor * factor & (1 << 64) - 1
        span *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h | np.uint64(1)  # 0 stands for no window


def anchors(data: np.ndarray, edges: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the k-grams that are smallest in some window of `length` bytes inside one document.

    data: documents end to end; edges: where they begin, and the end.
    """
    width = length - gram + 1
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    if len(data) > PART_BYTES + length:
        parts = []
        for s in range(0, len(data) - length + 1, PART_BYTES):
            part = data[s : s + PART_BYTES + length - 1]
            at, h = anchors(part, np.unique(np.clip(edges - s, 0, len(part))), length, gram)
            parts.append((at + s, h))
        at, first = np.unique(np.concatenate([x for x, _ in parts]), return_index=True)
        return at, np.concatenate([h for _, h in parts])[first]
    h = gram_hashes(data, gram)
    least = _sliding(h, width, np.minimum)  # of the window that starts here
    valid = np.zeros(len(least) + 1, np.int32)
    starts, ends = edges[:-1], edges[1:] - length + 1
    inside = ends > starts
    np.add.at(valid, starts[inside], 1)
    np.add.at(valid, ends[inside], -1)
    least[np.cumsum(valid[:-1]) == 0] = 0
    padding = np.zeros(width - 1, np.uint64)
    most = _sliding(np.concatenate([padding, least, padding]), width, np.maximum)  # over the windows that hold the gram
    at = np.flatnonzero(most == h)
    return at, h[at]


def _fold(batch: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Anchors of a slice, equal contexts folded to the first; the spans of the others come out as repeats (m null)."""
    m, c, doc, tag, at, lo, hi = (np.concatenate(x) for x in zip(*batch, strict=True))
    if not len(m):
        return
    order = np.lexsort((at, tag, doc, c, m))
    m, c, doc, tag, at, lo, hi = (x[order] for x in (m, c, doc, tag, at, lo, hi))
    same = np.append(False, (m[1:] == m[:-1]) & (c[1:] == c[:-1]))
    first = np.flatnonzero(~same)
    head = first[np.cumsum(~same) - 1]
    again = same & (doc == doc[head]) & (tag == tag[head]) & (at == at[head])
    new, old = ~same, same & ~again
    yield _rows(m[new], c[new], doc[new], tag[new], at[new], lo[new], hi[new], np.zeros(int(new.sum()), bool))
    if old.any():
        yield _rows(None, None, doc[old], tag[old], None, lo[old], hi[old], np.zeros(int(old.sum()), bool))


def _find_anchors(length: int, gram: int, fold: bool = True):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        before, after = length - gram, length
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or b"" for t in text_bytes(batch.column("text"))]
            docs = np.array([NULL_ID if d is None else d for d in batch.column("doc_id").to_pylist()], np.int64)
            tags = np.array([tag_of(t) for t in texts], np.int64)
            edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            joined = b"".join(texts)
            at, h = anchors(np.frombuffer(joined, np.uint8), edges, length, gram)
            row = np.searchsorted(edges, at, side="right") - 1
            lo, hi = np.maximum(edges[row], at - before), np.minimum(edges[row + 1], at + after)
            digest = xxhash.xxh64_intdigest
            start = edges[row]
            if fold:
                c = [digest(joined[a:b], i - a) for a, b, i in zip(lo.tolist(), hi.tolist(), at.tolist(), strict=True)]
            else:  # no two are equal
                c = [digest(f"{d} {t} {i}") for d, t, i in zip(docs[row].tolist(), tags[row].tolist(), (at - start).tolist(), strict=True)]
            c = np.array(c, np.uint64).view(np.int64)
            held.append((h.view(np.int64), c, docs[row], tags[row], at - start, lo - start, hi - start))
            size += len(joined)
            if size >= 8 << 20:
                yield from _fold(held)
                held, size = [], 0
        if held:
            yield from _fold(held)

    return find


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by m, c, doc, tag, at: repeats of a context come out with m null, firsts of an m with several contexts with `more` set."""
    last = None  # of the rows so far: m, c, then doc, tag, at of the first of this context
    waiting = None  # the first context of this m, until a second one shows
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        null = np.asarray(batch.column("m").is_null())
        if null.any():
            passed = np.flatnonzero(null)
            yield _rows(None, None, *(batch.column(k).to_numpy(zero_copy_only=False)[passed].astype(np.int64) for k in ("doc", "tag")), None, *(batch.column(k).to_numpy(zero_copy_only=False)[passed].astype(np.int64) for k in ("lo", "hi")), np.zeros(len(passed), bool))
            batch = batch.filter(pa.array(~null))
            n = batch.num_rows
            if not n:
                continue
        m, c, doc, tag, at, lo, hi = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for k in _NAMES[:7])
        same_m = np.append(last is not None and last[0] == m[0], m[1:] == m[:-1])
        same = same_m & np.append(last is not None and last[1] == c[0], c[1:] == c[:-1])
        new = ~same
        run = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        own = np.where(run >= 0, firsts[np.maximum(run, 0)] if len(firsts) else 0, -1)
        head = np.stack([doc, tag, at], 1)[np.maximum(own, 0)]
        if last is not None:
            head[own < 0] = last[2:5]
        again = same & (head[:, 0] == doc) & (head[:, 1] == tag) & (head[:, 2] == at)
        old = same & ~again
        if old.any():
            yield _rows(None, None, doc[old], tag[old], None, lo[old], hi[old], np.zeros(int(old.sum()), bool))
        # A context has others beside it if the context before it, or the one after it, has the same m.
        second = new & same_m
        if len(firsts):
            follows = second[firsts]
            leads = np.append(follows[1:], False)
            chosen = firsts[follows | leads]
            parts = [(m[chosen], c[chosen], doc[chosen], tag[chosen], at[chosen], lo[chosen], hi[chosen])]
            if follows[0] and waiting is not None:
                parts.append(tuple(np.array([v]) for v in waiting))
            if sum(len(p[0]) for p in parts):
                joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
                yield _rows(*joined, np.ones(len(joined[0]), bool))
            k = firsts[-1]
            waiting = None if follows[-1] else tuple(int(v[k]) for v in (m, c, doc, tag, at, lo, hi))
            last = (m[k], c[k], doc[k], tag[k], at[k])


def _resolve(found: DataFrame, parts: int) -> DataFrame:
    """One pass of step 1 over anchor rows; rows that are spans already pass through."""
    dealt = found.repartition(parts, F.coalesce("m", F.xxhash64("doc", "lo")))
    return dealt.sortWithinPartitions("m", "c", "doc", "tag", "at").mapInArrow(_stream, _ANCHOR)


class RunLengthIndex:
    """A run-compressed BWT of contexts, each ended by a separator of its own, with samples at run heads.

    Separators order by their place, so suffixes that agree up to the separator are ordered by position and no match
    crosses one.
    """

    def __init__(self, contexts: list[bytes]):
        sizes = np.array([len(x) + 1 for x in contexts])
        n = int(sizes.sum())
        text = np.zeros(n, np.int64)
        ends = np.cumsum(sizes) - 1
        body = np.ones(n, bool)
        body[ends] = False
        text[body] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64) + 1
        self.text, self.n = text, n
        #: Bytes up to the separator.
        self.room = np.repeat(ends, sizes) - np.arange(n)
        order = self._suffixes(int(sizes.max()))  # needed for the samples only
        before = np.where(order > 0, text[order - 1], 0)
        # Characters before a suffix; separators differ from one another, so each is a run of its own.
        at = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | (before[1:] == 0)))
        #: The transform: the character of each run, and where runs begin.
        self.runs, self.run_starts = before[at], at
        head, tail = order[at], np.append(-1, order)[at]
        by_place = np.argsort(head)
        #: For each run, by place in the text: the suffix at its head, the one at the end of the run before, and what both have in common.
        self.head, self.tail = head[by_place], tail[by_place]
        self.common = self._common(self.head, self.tail)

    def _suffixes(self, deepest: int) -> np.ndarray:
        """Suffix order to the depth of the longest context: ranks by their first bytes are put together, three at a time where they fit into 64 bits, else two."""
        n, packed = self.n, np.zeros(self.n, np.int64)
        padded = np.append(self.text, np.zeros(7, np.int64))
        open_ = np.ones(n, bool)
        for k in range(7):
            symbol = np.where(open_, padded[k : n + k], 0)
            packed = packed * 257 + symbol
            open_ &= symbol > 0
        depth, times = 7, 3 if (n + 1) ** 3 < 1 << 63 else 2
        while depth < deepest:
            order = np.argsort(packed)
            values = packed[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(0, values[1:] != values[:-1]))
            packed = rank
            for k in range(1, times):
                later = np.zeros(n, np.int64)
                reach = np.flatnonzero(self.room > k * depth)
                later[reach] = rank[reach + k * depth] + 1
                packed = packed * (n + 1) + later
            depth *= times
        return np.argsort(packed, kind="stable")  # equal ones by place

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a[i] and b[i], separators excluded; 0 where b[i] is none."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero(b >= 0)
        limit = np.zeros(len(a), np.int64)
        limit[live] = np.minimum(self.room[a[live]], self.room[b[live]])
        live = live[limit[live] > 0]
        while len(live):
            equal = self.text[a[live] + out[live]] == self.text[b[live] + out[live]]
            live = live[equal]
            out[live] += 1
            live = live[out[live] < limit[live]]
        return out

    def matching_statistics(self, block: int = 1 << 16) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Streams over the text, a block of positions at a time: the suffix before each in order (-1: none), and the length of their common prefix.

        Inside a run all suffixes have the same character before them, so between two sampled places both move on together: the suffix before by one
        position, and the common prefix falls by one.
        """
        for start in range(0, self.n, block):
            at = np.arange(start, min(start + block, self.n))
            run = np.searchsorted(self.head, at, side="right") - 1
            moved = at - self.head[run]
            known = (run >= 0) & (self.tail[run] >= 0)
            yield slice(start, start + len(at)), np.where(known, self.tail[run] + moved, -1), np.where(known, np.maximum(self.common[run] - moved, 0), 0)

    def earliest(self, keys: np.ndarray, length: int) -> np.ndarray:
        """For each position the smallest key among the occurrences of its next `length` bytes (its own if there are fewer).

        Occurrences are a chain: from each one to the suffix before it in order, as long as they agree in so many bytes.
        """
        top = np.arange(self.n)
        for place, above, common in self.matching_statistics():
            linked = common >= length
            top[place][linked] = above[linked]
        while True:  # to the top of every chain
            further = top[top]
            if np.array_equal(further, top):
                break
            top = further
        least = keys.copy()
        np.minimum.at(least, top, keys)
        return least[top]


def _mark(contexts: list[bytes], doc: np.ndarray, tag: np.ndarray, lo: np.ndarray, length: int) -> pa.RecordBatch:
    """Spans of repeats in a bucket of contexts."""
    index = RunLengthIndex(contexts)
    _, which = np.unique(np.stack([doc, tag], 1), axis=0, return_inverse=True)
    sizes = np.array([len(x) + 1 for x in contexts])
    begin = np.cumsum(sizes) - sizes
    inside = np.arange(index.n) - np.repeat(begin, sizes)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    keys = (which.reshape(-1)[owner] << 36) + lo[owner] + inside
    found = np.flatnonzero(index.earliest(keys, length) < keys)
    if not len(found):
        return _rows(None, None, [], [], None, [], [], [])
    new = np.append(True, (found[1:] != found[:-1] + 1) | (owner[found[1:]] != owner[found[:-1]]))
    first, last = found[new], found[np.append(new[1:], True)]
    o = owner[first]
    return _rows(None, None, doc[o], tag[o], None, lo[o] + inside[first], lo[o] + inside[last] + length, np.zeros(len(first), bool))


def _agreement(parts: list[bytes]) -> list[int]:
    """For each part the longest prefix that it shares with another one; in sorted order a neighbour has it."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    out = [0] * len(parts)
    for a, b in zip(order, order[1:], strict=False):
        x, y = parts[a], parts[b]
        n = min(len(x), len(y))
        differing = int.from_bytes(x[:n]) ^ int.from_bytes(y[:n])
        same = n - (differing.bit_length() + 7) // 8
        out[a], out[b] = max(out[a], same), max(out[b], same)
    return out


def shared(group: list[tuple], length: int) -> tuple[list[tuple], list[tuple]]:
    """The contexts of an m, cut to what each can share with others: (first of each cut, spans of its repeats).

    group: (m, doc, tag, lo, at, bytes), ordered. A string that two contexts share reaches no farther from the anchor, to either
    side, than they agree, so a context that agrees with none over `length` bytes in all shares none.
    """
    if len(group) < 2:
        return [], []
    left = _agreement([x[5][x[4] - x[3] - 1 :: -1] if x[4] > x[3] else b"" for x in group])
    right = _agreement([x[5][x[4] - x[3] :] for x in group])
    seen: set[tuple[int, bytes]] = set()
    first, again = [], []
    for (m, doc, tag, lo, at, data), before, after in zip(group, left, right, strict=True):
        if before + after < length:
            continue
        cut = data[at - lo - before : at - lo + after]
        if (before, cut) in seen:
            again.append((doc, tag, at - before, at + after))
        else:
            seen.add((before, cut))
            first.append((m, doc, tag, at - before, at, cut))
    return first, again


def _index_buckets(length: int):
    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts come sorted by m; a bucket ends with an m, so all contexts of an m are in one."""
        held: list[tuple] = []
        spans: list[tuple] = []
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("m", "doc", "tag", "lo", "at", "bytes")), strict=True):
                if group and row[0] != group[0][0]:
                    first, again = shared(group, length)
                    held += first
                    spans += again
                    size += sum(len(x[5]) for x in first)
                    group = []
                    if size >= BUCKET_BYTES:
                        yield from solve(held, spans)
                        held, spans, size = [], [], 0
                group.append(row)
        first, again = shared(group, length)
        yield from solve(held + first, spans + again)

    def solve(rows: list[tuple], spans: list[tuple]) -> Iterator[pa.RecordBatch]:
        if spans:
            doc, tag, lo, hi = (np.array(x, np.int64) for x in zip(*spans, strict=True))
            yield _rows(None, None, doc, tag, None, lo, hi, np.zeros(len(doc), bool))
        if rows:
            _, doc, tag, lo, _, data = zip(*rows, strict=True)
            yield _mark(list(data), *(np.array(x, np.int64) for x in (doc, tag, lo)), length)

    return index


def _windows(length: int):
    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every window of a context as a row of its own, folded as anchors are."""
        for batch in slices(batches, "bytes", 1 << 18):
            out: list[list[int]] = [[], [], [], [], []]
            for doc, tag, lo, data in zip(*(batch.column(k).to_pylist() for k in ("doc", "tag", "lo", "bytes")), strict=True):
                for i in range(len(data) - length + 1):
                    x = xxhash.xxh128_intdigest(data[i : i + length])
                    for column, value in zip(out, (x >> 64, x & (1 << 64) - 1, doc, tag, lo + i), strict=True):
                        column.append(value)
            m, c = (np.array(x, np.uint64).view(np.int64) for x in out[:2])
            doc, tag, at = (np.array(x, np.int64) for x in out[2:])
            yield from _fold([(m, c, doc, tag, at, at, at + length)])

    return split


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that are asked of a document."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    for batch in slices(batches, "text", 4 << 20):
        out: list[list] = [[], [], [], [], [], [], []]
        for doc, tag, text, asked in zip(batch.column("doc").to_pylist(), batch.column("tag").to_pylist(), text_bytes(batch.column("text")), batch.column("asked").to_pylist(), strict=True):
            for x in asked:
                for column, value in zip(out, (x["m"], doc, tag, x["lo"], x["at"], text[x["lo"] : x["hi"]], x["hot"]), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["m", "doc", "tag", "lo", "at", "bytes", "hot"])


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, fold: bool = True) -> DataFrame:
    """(doc, tag, lo, hi): spans of bytes that are covered by repeats; they may overlap. See document_key for doc and tag.

    Without fold, equal contexts aren't folded by their hashes, and the index marks them all; the spans cover the same bytes.
    """
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    least = partitions_for(spark, texts.count(), 5_000)
    found = texts.mapInArrow(_find_anchors(length, gram, fold), _ANCHOR)
    seen = written(_resolve(found, least), "repeats")
    spans = seen.where("NOT more").select("doc", "tag", "lo", "hi")
    edge = seen.where("more").select("m", "doc", "tag", "at", "lo", "hi")
    large = written(edge.groupBy("m").count().where(F.col("count") > hot).select("m", F.lit(True).alias("hot")), "hot")
    n_large = large.count()  # at most a row for each `hot` contexts; beyond a bound the join shuffles instead
    marked = edge.join(F.broadcast(large) if n_large <= MOST_HOT else large, "m", "left") if n_large else edge.withColumn("hot", F.lit(False))
    asked = marked.groupBy("doc", "tag").agg(F.collect_list(F.struct("m", "at", "lo", "hi", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))
    keyed = texts.select(*document_key(), "text").where(F.length("text") > 0)
    with small_batches(spark):
        contexts = written(keyed.join(asked, ["doc", "tag"]).dropDuplicates(["doc", "tag"]).mapInArrow(_fetch, "m bigint, doc bigint, tag bigint, lo bigint, at bigint, bytes binary, hot boolean"), "contexts")
    n = partitions_for(spark, contexts.count(), 40_000)
    plain = contexts.where("NOT hot").repartition(n, "m").sortWithinPartitions("m", "doc", "tag", "at").mapInArrow(_index_buckets(length), _ANCHOR)
    single = _resolve(contexts.where("hot").mapInArrow(_windows(length), _ANCHOR), n).where("NOT more")
    return spans.unionByName(plain.select("doc", "tag", "lo", "hi")).unionByName(single.select("doc", "tag", "lo", "hi"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def without(texts: list[bytes], spans: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """What the spans, a list of (lo, hi) for each text, leave of it; the bytes removed and the maximal runs that they form."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)  # a byte between texts, so that no run goes on into the next
    begin = ends - sizes - 1
    row = np.repeat(np.arange(len(texts)), pa.compute.list_value_length(spans).fill_null(0).to_numpy())
    lo, hi = (x.to_numpy().astype(np.int64) + begin[row] for x in spans.flatten().flatten())
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.append(True, lo[1:] > reach[:-1])) if len(lo) else np.empty(0, np.int64)
    last = reach[np.append(first[1:], len(lo)) - 1] if len(lo) else first
    owner = row[order][first]
    turns = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int8)
    turns[lo[first]] += 1
    turns[last] -= 1
    gone = np.cumsum(turns[:-1], dtype=np.int8).astype(bool)
    gone[ends - 1] = True
    removed = np.zeros(len(texts), np.int64)
    np.add.at(removed, owner, last - lo[first])
    left = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)[~gone].tobytes()
    edges = np.append(0, np.cumsum(sizes - removed)).tolist()
    return [left[p:q] for p, q in zip(edges, edges[1:], strict=False)], removed, np.bincount(owner, minlength=len(texts))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, kept: str = "text", fold: bool = True) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans and kept: what is left as "text" (without bytes of characters that were cut apart), as "bytes", or as its "sha256" in hex."""
    names = [c for c in docs.columns if c not in ("n_bytes", "n_removed", "n_spans", "kept", "doc", "tag", "spans")]
    carried = [c for c in names if kept == "bytes" or c != "text"]
    found = repeats(docs, length, gram, hot, fold).groupBy("doc", "tag").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = docs.select(*names, *document_key()).join(found, ["doc", "tag"], "left").select(*names, "spans")
    schema = docs.select(*carried).schema
    shape = {"text": lambda x: x.decode("utf-8", "ignore"), "bytes": lambda x: x, "sha256": lambda x: hashlib.sha256(x).hexdigest()}[kept]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            texts = [t or b"" for t in text_bytes(batch.column("text"))]
            left, removed, runs = without(texts, batch.column("spans"))
            made = [*(pa.array(x, pa.int64()) for x in ([len(t) for t in texts], removed, runs)), pa.array([shape(x) for x in left], pa.binary() if kept == "bytes" else pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *made], names=[*carried, "n_bytes", "n_removed", "n_spans", "kept"])

    out = schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary" if kept == "bytes" else "string")
    return joined.mapInArrow(cut, out)


def oracle(length: int = LENGTH) -> str:
    """DuckDB SQL for the rows of query op9, over hexadecimal text."""
    return f"""
    WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, {2 * length})) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length - 1})) AS i FROM d)),
    m AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
    g AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {length} THEN 0 ELSE 1 END AS new FROM m),
    s AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM g),
    r AS (SELECT doc_id, min(i) AS lo, max(i) + {length} AS hi FROM s GROUP BY doc_id, run),
    p AS (SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM r),
    c AS (SELECT doc_id, sum(hi - lo) AS gone, count(*) AS n, max(hi) AS last, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS kept FROM p JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, length(h)::BIGINT // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
    FROM d LEFT JOIN c USING (doc_id)"""
