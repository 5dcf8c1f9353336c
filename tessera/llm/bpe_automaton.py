"""BPE encoding and decoding by a tokenization automaton compiled from the merges.

The token automaton's arcs are labelled with tokens and its paths are exactly the token sequences that the merges produce. It
starts as one state with a loop for each base symbol. A merge a, b -> ab adds one gadget: the state p that arcs labelled
a lead to is cloned without its arc b, arcs labelled a lead to the clone from now on, and every state with an arc a gets
an arc ab that leads where b led from p. So all arcs of one label lead to one state (``target``), and a state is the one it was cloned
from less one arc. Clones of the states that one label led to make a line (``line``), in the order in which they were made (``made``), and what a line
lost when is a table (``lost``), so that whether a state has an arc takes a look-up for each line that it goes back to.

Words are encoded by a deterministic automaton over base symbols, the subset construction of the token automaton: a state is the
set of arcs under way, each a node in the trie of labels and the state that it left, and exactly one arc ends at each symbol, as every
string has one path. Its transitions are a table, filled when first needed and emptied when it holds ``MOST_STATES``. Encoding is
one walk over this table, never back, noting the label that ends at each symbol; read from the end, these labels give the path.
Words, the pieces that the pre-tokenizer splits off, are encoded alike wherever they stand, and a bounded cache holds their ids. Decoding
emits the arc labels.

Normalizing and splitting follow the file. Code points on which Python's tables may differ from the tokenizers library's, found once
by comparing all, send their text through the file's own normalizer.

Defined cases: a null text counts as empty and has no tokens; an empty text decodes to an empty text; strings of the added tokens in a text become their
ids; lone surrogates can't occur in UTF-8 columns; repeated rows give repeated rows; an empty table gives no rows; a very long text is one row in memory; other
columns are ignored. Memory is bounded by the tables, looked at before each new state even inside a word, the two caches, bounded in words and characters, and what one text
needs: its words and, for each distinct one, its ids and its decoded form. The file's content is sent to the tasks.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slices
from .packing import byte_alphabet

#: White space as Unicode has it, which is what the pre-tokenizer's \s means.
SPACE = "\t-\r \x85\xa0  -     　"
MOST_WORDS = 500_000
#: Characters of words, ids and decoded words that the caches hold before they are emptied; the text at hand comes on top.
MOST_HELD = 100_000_000
MOST_STATES = 200_000
_LOADED: dict[int, Tokenizer] = {}


class Automaton:
    """States are numbers, labels are token ids; state 0 is the start."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        top = max(vocab.values()) + 1
        self.labels = [""] * top
        for token, i in vocab.items():
            self.labels[i] = token
        self.target, self.parts, self.born = [0] * top, [None] * top, [-1] * top
        self.second, self.lost = [-1] * top, {}
        self.line, self.made = [-1], [-1]
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocab[a], vocab[b], vocab[a + b])
        #: A trie over base symbols; the last symbol of a word bears the suffix and is a symbol of its own.
        self.down: list[dict[str, int]] = [{}]
        self.ends = [-1]
        self.width = [0] * top
        for token, i in vocab.items():
            symbols = self.symbols(token.removesuffix(suffix), token.endswith(suffix) and token != suffix, suffix)
            self.width[i] = len(symbols)
            if len(symbols) > 1 and self.parts[i] is None:
                continue
            node = 0
            for s in symbols:
                if s not in self.down[node]:
                    self.down[node][s] = len(self.down)
                    self.down.append({})
                    self.ends.append(-1)
                node = self.down[node][s]
            self.ends[node] = i
        self.suffix = suffix
        self._reset()

    def _reset(self) -> None:
        self.table: list[dict[str, int]] = [{}]  # transitions
        self.under_way = [((0, 0),)]  # trie node, state that the arc left
        self.ended = [-1]  # label of the arc that ends here
        self.known = {(-1, self.under_way[0]): 0}

    @staticmethod
    def symbols(word: str, ends: bool, suffix: str) -> list[str]:
        return [*word[:-1], word[-1] + suffix] if ends and word else list(word)

    def _gadget(self, rank: int, a: int, b: int, ab: int) -> None:
        r = self.target[b]
        self.target[a] = len(self.line)  # the clone
        self.line.append(a)
        self.made.append(rank)
        self.lost[a * len(self.target) + b] = rank
        self.target[ab], self.parts[ab], self.second[ab], self.born[ab] = r, a, b, rank

    def _has(self, state: int, label: int) -> bool:
        """Whether the state has the arc: at each step back to the label's first part, no state that it was cloned from, by then, may have lost the arc."""
        before, top, born = len(self.made), len(self.target), self.born
        while True:
            line, until = self.line[state], min(before, self.made[state] + 1)
            while line >= 0:
                lost = self.lost.get(line * top + label, -1)
                if born[label] < lost < until:
                    return False
                # The line of ab began as the state that b led to when ab was born.
                until, line = min(until, born[line]), self.second[line]
            if self.parts[label] is None:
                return True
            # The arc ab was given at its birth to states that had the arc a just then, after a's own loss of b.
            before, label = born[label] + 1, self.parts[label]

    def _step(self, at: int, symbol: str) -> int:
        """The transition of a state, made."""
        after, label = [], -1
        for node, left in self.under_way[at]:
            node = self.down[node].get(symbol)
            if node is None:
                continue
            if self.down[node]:
                after.append((node, left))
            if label < 0 and self.ends[node] >= 0 and self._has(left, self.ends[node]):  # the only one
                label = self.ends[node]
        after.append((0, self.target[label]))
        to = self.table[at][symbol] = self._state((label, tuple(after)))
        return to

    def _state(self, key: tuple) -> int:
        """The state of an ended label and the arcs under way, made if it is new."""
        at = self.known.get(key)
        if at is None:
            at = self.known[key] = len(self.table)
            self.table.append({})
            self.under_way.append(key[1])
            self.ended.append(key[0])
        return at

    def encode(self, word: str) -> list[int]:
        """Token ids of one pre-split word in byte-level characters."""
        table, ended, at, labels = self.table, self.ended, 0, []
        for symbol in self.symbols(word, True, self.suffix):
            to = table[at].get(symbol)
            if to is None:
                if len(table) >= MOST_STATES:  # the walk goes on in an empty table, from the state that it is in
                    key = ended[at], self.under_way[at]
                    self._reset()
                    table, ended = self.table, self.ended
                    at = self._state(key)
                to = self._step(at, symbol)
            at = to
            labels.append(ended[at])
        out, i = [], len(labels)
        while i:
            out.append(labels[i - 1])
            i -= self.width[out[-1]]
        return out[::-1]


def _code_points(block: int = 1 << 13) -> Iterator[list[str]]:
    """All code points beyond ASCII but surrogates, a block at a time."""
    for start in range(0, 0x110000, block):
        if part := [chr(i) for i in range(max(start, 0x80), start + block) if not 0xD800 <= i < 0xE000]:
            yield part


def _differing(kind: str) -> str:
    """Ranges of code points that this regex module counts to the class and the tokenizers library, of an older Unicode, doesn't."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}"), "removed", invert=True)
    out = []
    for every in _code_points():
        ours = regex.findall(rf"\p{{{kind}}}", "".join(every))
        theirs = {c for c, _ in split.pre_tokenize_str(" ".join(ours))}
        out += [ord(c) for c in ours if c not in theirs]
    return _ranges(out)


def _split_pattern(pattern: str) -> str:
    """The file's pattern with white space, letters and numbers as the tokenizers library has them."""
    letters, numbers = _differing("L"), _differing("N")
    other = rf"(?:[^{SPACE}\p{{L}}\p{{N}}]" + (f"|[{letters}{numbers}]" if letters + numbers else "") + ")+"
    return pattern.replace(r"[^\s\p{L}\p{N}]+", other).replace(r"[\p{L}]+", rf"[^\P{{L}}{letters}]+").replace(r"[\p{N}]", rf"[^\P{{N}}{numbers}]")


def _ranges(points: Iterable[int]) -> str:
    """Ascending code points as ranges of a character class."""
    out: list[list[int]] = []
    for c in points:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def _lower(text: str) -> str:
    """What the normalizer does, but for white space, which the pre-tokenizer drops, by Python's tables."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def _unsettled(normalize) -> str:
    """Ranges of code points for which Python's tables don't settle what the file's normalizer does with a text that has them.

    Those that the two treat differently alone, those that Python doesn't know, and those that were assigned after Unicode 3.2 and may
    compose or be reordered: what had been assigned before never changes how it is normalized.
    """
    old = unicodedata.ucd_3_2_0

    def open_(c: str) -> bool:
        if old.category(c) != "Cn":
            return False
        return unicodedata.category(c) == "Cn" or unicodedata.combining(c) != 0 or unicodedata.decomposition(c) != ""

    found = []
    for every in _code_points():
        alone = [c for c in every if not c.isspace()]
        theirs = normalize(" ".join(alone)).split(" ")
        found += [ord(c) for c, x in zip(alone, theirs, strict=True) if _lower(c) != x or open_(c)]
    return _ranges(found)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Ids(dict):
    def __init__(self, owner: Tokenizer):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: str) -> str:
        ids = self.owner.word_ids(word)
        out = self[word] = " ".join(map(str, ids))
        decoded = self.owner.decoded[word] = self.owner.decode(ids)
        self.owner.held += len(word) + len(out) + len(decoded)
        return out


class Tokenizer:
    """A tokenizers file whose model is BPE with a word suffix, byte-level characters and no decoder."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer as Library

        spec = json.loads(content)
        self.normalize = Library.from_str(content).normalizer.normalize_str
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.contents = {i: t for t, i in self.added.items()}
        #: Latin-1 text has no code point in which the two Unicode versions differ, and the plain pattern is faster.
        self.latin = regex.compile(steps[0]["pattern"]["Regex"].replace(r"[^\s", f"[^{SPACE}")).findall
        self.words = regex.compile(_split_pattern(steps[0]["pattern"]["Regex"])).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        self.chars = {b: c for b, c in byte_alphabet().items()}
        self.table = "".join(self.chars[b] for b in range(256))
        self.unsettled = re.compile(f"[{_unsettled(self.normalize)}]").search  # re has a bitmap for large classes
        self.ids, self.decoded, self.held = _Ids(self), {}, 0

    def word_ids(self, word: str) -> list[int]:
        if word in self.added:
            return [self.added[word]]
        return self.automaton.encode(word.encode().decode("latin-1").translate(self.table))

    def pre_split(self, text: str) -> list[str]:
        """Words and added tokens in order; what is an added token can't come out of normalized text as one word, for it has letters and signs."""
        parts = self.split(text) if self.split and "<|" in text else [text]
        out: list[str] = []
        for part in parts:
            if part in self.added:
                out.append(part)
            elif part:
                latin = part.isascii() or _is_latin(part)
                part = _lower(part) if latin or not self.unsettled(part) else self.normalize(part)
                out += (self.latin if latin else self.words)(part)
        return out

    def encode(self, text: str) -> list[int]:
        words = self.pre_split(text)
        self._make_room()
        return [int(i) for w in words for i in self.ids[w].split()]

    def _make_room(self) -> None:
        if len(self.ids) > MOST_WORDS or self.held > MOST_HELD:
            self.ids.clear()
            self.decoded.clear()
            self.held = 0

    def decode(self, ids: Iterable[int]) -> str:
        labels = self.automaton.labels
        return " ".join(self.contents.get(i) or labels[i] for i in ids)

    def both(self, text: str) -> tuple[str, str]:
        """The ids, joined by a space, and the decoded text."""
        words = self.pre_split(text)
        self._make_room()
        return " ".join(map(self.ids.__getitem__, words)), " ".join(map(self.decoded.__getitem__, words))


def load(content: str) -> Tokenizer:
    """The tokenizer of a file's content, made once for each process."""
    key = zlib.crc32(content.encode())
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(content)
    return _LOADED[key]


def _sent(df: DataFrame, path: str):
    """The file's content, where tasks find it."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids array<int> of every text."""
    held = _sent(docs, path)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(held.value)
        for batch in slices(batches, "text", 1 << 20):
            ids = [tokenizer.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ids; null ids count as none."""
    held = _sent(encoded, path)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(held.value)
        for batch in batches:
            texts = [tokenizer.decode(i or ()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, text string")


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and sha256 of the joined ids and of the decoded text: encode and decode in one pass."""
    held = _sent(docs, path)

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(held.value)
        for batch in slices(batches, "text", 1 << 20):
            out: list[list] = [[], [], []]
            for text in batch.column("text").to_pylist():
                ids, decoded = tokenizer.both(text or "")
                out[0].append(ids.count(" ") + 1 if ids else 0)
                out[1].append(hashlib.sha256(ids.encode()).hexdigest())
                out[2].append(hashlib.sha256(decoded.encode()).hexdigest())
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(out[0], pa.int64()), pa.array(out[1]), pa.array(out[2])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
