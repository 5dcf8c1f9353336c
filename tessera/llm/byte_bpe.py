"""Byte-level BPE encoding and decoding by a two-tier lookup.

Text is split by a pattern into pre-tokens, each encoded alone. Tier one: a minimal perfect hash over the vocabulary (hash and displace: every
token has a slot of its own and there are as many slots as tokens) gives the one token that a pre-token could be; if its bytes are equal, its rank is the result. Tier two,
for all other pre-tokens: the bytes are a doubly linked list, and a heap holds the ranks of adjacent parts, smallest rank first and leftmost first among equals; entries whose pair
has since changed are passed over. Ranks of byte pairs come from a table of 65,536 entries, those of longer parts from the same hash. A pre-token of n bytes takes n log n steps, so one
unbroken word of a million letters is no different from many words.

The hash is built once, on the driver, and sent to the tasks: its size is that of the vocabulary file, whatever the data. What has been looked up is kept for the words that follow, up to
a bound (``MOST_JOINED``, ``MOST_HELD``).

Defined cases: a null text counts as empty; an empty text has no tokens and decodes to no bytes; strings of special tokens are ordinary text; lone surrogates can't
occur in UTF-8 columns; a null id is kept; repeated rows give repeated rows; an empty table gives no rows; a very long text is one row in memory, with a few times its size for
its pre-tokens; other columns are ignored. Null ids decode to no bytes; an id outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .bpe_automaton import _code_points, _is_latin, _ranges
from .common import slices

#: Multiplier that makes a second hash, the step of a displacement, out of the first.
_STEP = 0x9E3779B97F4A7C15
#: Pairs of tokens whose rank is kept, and characters of words, ids and decoded words; the text at hand comes on top.
MOST_JOINED = 500_000
MOST_HELD = 50_000_000
_WHOLE = (1 << 64) - 1
_NONE = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with one base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class MinimalPerfectHash:
    """Keys to 0 ... len(keys) - 1, each number once.

    Keys fall into buckets by their hash. Buckets are placed from the largest down: the smallest displacement d for which the slots (hash + d * step(hash)) mod n of all keys of the bucket are
    free. A bucket of one key takes a free slot outright, noted as a negative displacement.
    """

    def __init__(self, keys: list[bytes], load: int = 2):
        self.n = n = len(keys)
        self.buckets = max(1, n // load)
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(hashes)) < n:
            raise ValueError("two keys of equal 64-bit hash")
        bucket = ((hashes >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        free = np.ones(n, bool)
        displacement = np.zeros(self.buckets, np.int64)
        slots = np.zeros(n, np.int64)
        tries = np.arange(256, dtype=np.uint64)[:, None]
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            members = order[starts[b] : starts[b + 1]]
            h = hashes[members]
            step = self._step(h)
            first = 0
            while True:
                at = ((h + (tries + np.uint64(first)) * step) % np.uint64(n)).astype(np.int64)
                fits = free[at].all(axis=1)
                if len(members) > 1:
                    ordered = np.sort(at, axis=1)
                    fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if fits.any():
                    k = int(fits.argmax())
                    displacement[b] = first + k
                    slots[members] = at[k]
                    free[at[k]] = False
                    break
                first += len(tries)
        alone = np.flatnonzero(sizes == 1)
        left = np.flatnonzero(free)[: len(alone)]
        displacement[alone] = -1 - left
        slots[order[starts[alone]]] = left
        self.displacement = displacement.tolist()
        self.slots = slots

    @staticmethod
    def _step(h):
        return h * np.uint64(_STEP) >> np.uint64(20) | np.uint64(1)

    def slot(self, key: bytes) -> int:
        """The slot of a key; that of any other string is the slot of some key."""
        h = xxhash.xxh64_intdigest(key)
        d = self.displacement[(h >> 32) % self.buckets]
        return -1 - d if d < 0 else ((h + d * ((h * _STEP & _WHOLE) >> 20 | 1)) & _WHOLE) % self.n


class Vocabulary:
    """Ranks by the two-tier lookup, and tokens by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"single bytes without a rank: {missing}")
        keys = list(ranks)
        self.hash = MinimalPerfectHash(keys)
        self.keys: list[bytes] = [b""] * len(keys)
        self.ranks = [0] * len(keys)
        for key, slot in zip(keys, self.hash.slots.tolist(), strict=True):
            self.keys[slot], self.ranks[slot] = key, ranks[key]
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for key, rank in ranks.items():
            self.tokens[rank] = key
        self.pairs = [ranks.get(bytes([a, b]), _NONE) for a in range(256) for b in range(256)]
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.joined: dict[int, int] = {}

    def __getstate__(self):
        return self.__dict__ | {"joined": {}}

    def rank(self, part: bytes) -> int:
        slot = self.hash.slot(part)
        return self.ranks[slot] if self.keys[slot] == part else _NONE

    def _join(self, pair: int) -> int:
        """The rank of two tokens put together; those asked for last are kept, up to MOST_JOINED."""
        if len(self.joined) >= MOST_JOINED:
            self.joined.clear()
        out = self.joined[pair] = self.rank(self.tokens[pair >> 32] + self.tokens[pair & 0xFFFFFFFF])
        return out

    def encode_word(self, word: bytes) -> list[int]:
        """Ranks of the tokens of one pre-token."""
        whole = self.rank(word)
        return [whole] if whole != _NONE else self.merge(word)

    def merge(self, word: bytes) -> list[int]:
        """The heap over linked bytes. Parts are known by their first byte; `after` and `before` link them, `token` is a part's rank and `pair` that of a part with the one after it."""
        n, pairs, known = len(word), self.pairs, self.joined.get
        token = [self.single[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [pairs[a << 8 | b] for a, b in zip(word, word[1:], strict=False)]
        heap = [r << 40 | i for i, r in enumerate(pair) if r != _NONE]
        pair.append(_NONE)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            i, r = entry & _NONE - 1, entry >> 40
            if pair[i] != r:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            token[i] = r
            pair[gone] = -1
            if end < n:
                before[end] = i
                both = r << 32 | token[end]
                joined = known(both)
                if joined is None:
                    joined = self._join(both)
                pair[i] = joined
                if joined != _NONE:
                    heappush(heap, joined << 40 | i)
            else:
                pair[i] = _NONE
            if i:
                k = before[i]
                both = token[k] << 32 | r
                joined = known(both)
                if joined is None:
                    joined = self._join(both)
                pair[k] = joined
                if joined != _NONE:
                    heappush(heap, joined << 40 | k)
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _unknown(kind: str) -> str:
    """Ranges of code points that the regex module counts to a class and the tiktoken library, of an older Unicode, doesn't."""
    import tiktoken

    probe = tiktoken.Encoding(kind, pat_str=rf"\p{{{kind}}}", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    found: list[int] = []
    for every in _code_points():
        ours = "".join(regex.findall(rf"\p{{{kind}}}", "".join(every)))
        theirs = set(probe.decode(probe.encode_ordinary(ours)))
        found += [ord(c) for c in ours if c not in theirs]
    return _ranges(found)


def as_tiktoken_splits(pattern: str) -> str:
    """The pattern with the letters and numbers that the tiktoken library knows."""
    letters, numbers = _unknown("L"), _unknown("N")
    other = r"(?:[^\s\p{L}\p{N}]" + (f"|[{letters}{numbers}]" if letters + numbers else "") + ")+"
    return pattern.replace(r"[^\s\p{L}\p{N}]+", other).replace(r"\p{L}+", rf"[^\P{{L}}{letters}]+").replace(r"\p{N}+", rf"[^\P{{N}}{numbers}]+")


def latin_pattern(pattern: str) -> str:
    """The pattern for texts of code points below 256, its classes spelt out, for the plainer and faster module."""
    every = [chr(c) for c in range(256)]
    of = {kind: "".join(map(re.escape, regex.findall(kind, "".join(every)))) for kind in (r"\p{L}", r"\p{N}", r"\s")}
    out = pattern.replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(of.values()) + "]").replace(r"\S", f"[^{of[chr(92) + 's']}]")
    for kind, inside in of.items():
        out = out.replace(kind, f"[{inside}]")
    return out


class Tokenizer:
    """A vocabulary with the pattern that splits text into pre-tokens. Words that texts have in common are encoded once, until the cache holds MOST_HELD characters."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, settled: str):
        self.vocabulary = vocabulary
        self.latin = re.compile(latin_pattern(pattern)).findall
        self.words = regex.compile(settled).findall
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}
        self.held = 0

    def pre_split(self, text: str) -> list[str]:
        return self.latin(text) if _is_latin(text) else self.words(text)

    def both(self, text: str) -> tuple[str, bytes]:
        """The ids, joined by a space, and the bytes decoded from them."""
        words = self.pre_split(text)
        if self.held > MOST_HELD:
            self.ids.clear()
            self.decoded.clear()
            self.held = 0
        for word in set(words).difference(self.ids):
            ids = self.vocabulary.encode_word(word.encode())
            self.ids[word] = " ".join(map(str, ids))
            self.decoded[word] = self.vocabulary.decode(ids)
            self.held += 2 * len(word) + len(self.ids[word])
        return " ".join(map(self.ids.__getitem__, words)), b"".join(map(self.decoded.__getitem__, words))

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(self.vocabulary.encode_word(w.encode()) for w in self.pre_split(text)))


def make(path: str, pattern: str) -> Tokenizer:
    return Tokenizer(Vocabulary(read_ranks(path)), pattern, as_tiktoken_splits(pattern))


def _sent(df: DataFrame, path: str, pattern: str):
    """What a tokenizer is made of, where tasks find it."""
    return df.sparkSession.sparkContext.broadcast((Vocabulary(read_ranks(path)), pattern, as_tiktoken_splits(pattern)))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids array<int> of every text."""
    sent = _sent(docs, path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(*sent.value)
        for batch in slices(batches, "text", 1 << 20):
            ids = [tokenizer.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the decoded bytes of every row of ids."""
    held = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in read_ranks(path).items()})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = held.value
        for batch in batches:
            out = [b"".join(map(tokens.__getitem__, ids or ())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and sha256 of the joined ids and of the bytes decoded from them: encode and decode in one pass."""
    sent = _sent(docs, path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(*sent.value)
        for batch in slices(batches, "text", 1 << 20):
            out: list[list] = [[], [], []]
            for text in batch.column("text").to_pylist():
                ids, decoded = tokenizer.both(text or "")
                out[0].append(ids.count(" ") + 1 if ids else 0)
                out[1].append(hashlib.sha256(ids.encode()).hexdigest())
                out[2].append(hashlib.sha256(decoded).hexdigest())
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
