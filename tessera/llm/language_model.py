"""A gated recurrent language model with a class-factored softmax, trained by truncated backpropagation in numpy.

Tokens are the words of a text, A-Z lower-cased, and one end. A token's probability is P(class | state) * P(token | class, state).
The most frequent ``SHORT`` tokens form classes of ``PER_CLASS``, with a softmax over the state inside each; all other tokens are
classed by their last two bytes and drawn by their corpus counts, (c + 0.5) / (N + 0.5 * (V + 1)) within the class, where unseen tokens
of a class share one outcome. So every token has a probability, whatever the vocabulary.

Two passes read the texts: counts of all training tokens (slices of input are counted before the shuffle), then encoding, after which
a token is two bytes. The network starts from the counts as its biases and learns from every training document once: a hash of id and
text puts each into one of ``ROUNDS`` rounds and there into a group; every group updates a copy of its own over windows of ``WINDOW``
tokens with the state carried from window to window, and the copies are averaged, weighted by tokens, in a tree. Groups depend on
the rows alone, so weights and scores don't depend on how the table is partitioned, but for the rounding of sums. Scoring runs documents of like length in
lockstep, windows end to end with the state carried over, so a document's log-likelihood covers it whole.

Counts of frequent tokens (``TOP``, a bound) go to the tasks; the few other tokens of each document are joined to the table of
counts, which may be of any size.

Defined cases: a null or empty text is the end alone; null ids are kept and count as training documents; rows that repeat both id and text
learn in one group and are scored each on its own; equally frequent tokens are ordered by their bytes; a very long text is encoded whole, in one row, and learnt and scored window by window;
without training tokens every token is unseen; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import discard
from .common import slices, text_bytes, written

END = b"\n"
SHORT, PER_CLASS, TAIL = 4096, 128, 128
TOP = 300_000
HIDDEN = 24
#: Every training document is in one of the rounds, and there in one of the groups, each of about GROUP_TOKENS tokens, or more if there were more than MOST_GROUPS.
ROUNDS, GROUP_TOKENS, MOST_GROUPS = 2, 1_000_000, 1 << 14
STREAMS, WINDOW, LEAST_STEPS = 384, 16, 64
RATE = 0.01
CLIP = 60.0
HELD = 4_000_000
BATCH, SPAN = 512, 1 << 15
#: Rows whose logits are made together, and weights that are updated together: what fits a core's cache.
BLOCK, PART = 512, 1 << 14
#: Inputs that occur more often in a window have their gradients summed one by one.
MANY = 12
SEED = 3
#: Bytes of text that are split at once.
SLICE = 8 << 20
#: Counts of slices' words that a task holds until it sums them.
HELD_WORDS = 1_000_000


def tokens_of(text: bytes | None) -> list[bytes]:
    return [*text.lower().split(), END] if text else [END]


def split(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of lower-cased texts, and for each word of the texts its number and that of its text; ends are left out."""
    data = np.frombuffer(b"\n".join([b"", *(x.lower() if x else b"" for x in texts), b""]), np.uint8)
    inside = (data > 32) | ((data < 9) | (data > 13)) & (data != 32)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    encoded = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]).dictionary_encode()
    lengths = np.fromiter((len(x) + 1 if x else 1 for x in texts), np.int64, len(texts))
    many = np.diff(np.searchsorted(starts, np.cumsum(lengths)), prepend=0)
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(texts)), many)


class Vocabulary:
    """Ids of frequent tokens and classes of all. Ids below SHORT are in the softmax; TAIL classes follow the ranks' classes."""

    def __init__(self, top: list[tuple[bytes, int]], endings: dict[bytes, tuple[int, int]], total: int, types: int):
        """top: (token, count), most frequent first, without the end token, which comes first here; endings: over the tokens that aren't in the softmax."""
        self.total, self.types = total, types
        self.words = [w for w, _ in top]
        self.counts = np.array([c for _, c in top], float)
        self.known = pa.array(self.words, pa.binary())
        self.n_short = min(SHORT, len(self.words))
        self.n_ranks = SHORT // PER_CLASS
        common = sorted(endings, key=lambda e: (-endings[e][0], e))[: TAIL - 1]
        self.ending = {e: i for i, e in enumerate(common)}
        mass, kinds = np.zeros(TAIL), np.zeros(TAIL)
        for e, (n, v) in endings.items():
            k = self.ending.get(e, TAIL - 1)
            mass[k] += n
            kinds[k] += v
        self.mass = mass
        #: log10 of what a tail count is divided by.
        self.tail_norm = np.log10(mass + 0.5 * (kinds + 1))
        self.tail = np.array([self.tail_class(w) for w in self.words[self.n_short :]], np.int64)
        self.n_inputs = SHORT + TAIL + 1
        self.start = SHORT + TAIL

    @property
    def n_classes(self) -> int:
        return self.n_ranks + TAIL

    def tail_class(self, word: bytes) -> int:
        return self.ending.get(word[-2:], TAIL - 1)

    def class_mass(self) -> np.ndarray:
        short = np.zeros(SHORT)
        short[: self.n_short] = self.counts[: self.n_short]
        return np.concatenate([short.reshape(self.n_ranks, PER_CLASS).sum(1), self.mass])

    def encode(self, tokens: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(input ids, ranks): an input id is a rank in the softmax or SHORT + the tail class; a rank is -1 for tokens outside the top."""
        tokens = pa.array(tokens, pa.binary())
        index = lambda x, among, other: pa.compute.index_in(x, value_set=among).fill_null(other).to_numpy(zero_copy_only=False).astype(np.int64)
        ranks = index(tokens, self.known, -1)
        inputs = ranks.copy()
        known = ranks >= self.n_short
        inputs[known] = SHORT + self.tail[ranks[known] - self.n_short]
        inputs[ranks < 0] = SHORT + index(pa.compute.binary_slice(tokens.filter(pa.array(ranks < 0)), -2), pa.array(list(self.ending), pa.binary()), TAIL - 1)
        return inputs, ranks


class Network:
    """Weights in one flat vector, seen as named arrays. Biases are the last rows of the weights that they go with, so states carry a one behind them."""

    def __init__(self, vocabulary: Vocabulary, flat: np.ndarray | None = None, hidden: int = HIDDEN, seed: int = SEED):
        self.room = None
        self.hidden, self.n_ranks, self.n_classes, self.n_inputs = hidden, vocabulary.n_ranks, vocabulary.n_classes, vocabulary.n_inputs
        self.shapes = {"embed": (self.n_inputs, 3 * hidden), "loop": (hidden, 3 * hidden), "to_classes": (hidden + 1, self.n_classes), "to_words": (self.n_ranks, hidden + 1, PER_CLASS)}
        size = sum(int(np.prod(s)) for s in self.shapes.values())
        if flat is None:
            rng = np.random.default_rng(seed)
            self.flat = np.empty(size, np.float32)
            self._name()
            for named in (self.embed, self.loop, self.classes, self.class_bias, self.words, self.word_bias):
                named[:] = 0.1 * rng.standard_normal(named.shape)
            mass = vocabulary.class_mass() + 0.5
            self.class_bias[:] = np.log(mass / mass.sum())
            short = np.full(SHORT, 0.05)
            short[: vocabulary.n_short] += vocabulary.counts[: vocabulary.n_short]
            bias = np.log(short / short.max())
            # Ranks that no token has get no mass.
            bias[vocabulary.n_short :] = -30
            self.word_bias[:] = bias.reshape(self.word_bias.shape)
            if vocabulary.n_short < SHORT:
                empty = np.arange(vocabulary.n_ranks) * PER_CLASS >= vocabulary.n_short
                self.class_bias[: vocabulary.n_ranks][empty] = -30
        else:
            self.flat = flat
            self._name()

    def _name(self) -> None:
        at = 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n
        self.classes, self.class_bias = self.to_classes[:-1], self.to_classes[-1]
        self.words, self.word_bias = self.to_words[:, :-1], self.to_words[:, -1]

    def _loops(self) -> tuple[np.ndarray, np.ndarray]:
        """What _gates multiplies states with: the weights of the gates, negated, and those of the new state."""
        return -self.loop[:, : 2 * self.hidden], np.ascontiguousarray(self.loop[:, 2 * self.hidden :])

    def _gates(self, loops: tuple[np.ndarray, np.ndarray], h: np.ndarray, x: np.ndarray, zr: np.ndarray, gn: np.ndarray, n: np.ndarray, after: np.ndarray) -> None:
        """The state after inputs of embeddings x, into `after`, and what the gradient needs into the others."""
        k = self.hidden
        np.matmul(h, loops[0], out=zr)
        zr -= x[:, : 2 * k]
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        np.matmul(h, loops[1], out=gn)
        np.multiply(zr[:, k:], gn, out=n)
        n += x[:, 2 * k :]
        np.tanh(n, out=n)
        np.subtract(h, n, out=after)
        after *= zr[:, :k]
        after += n

    def step(self, h: np.ndarray, x: np.ndarray, loops: tuple[np.ndarray, np.ndarray] | None = None) -> tuple:
        """The state after inputs of embeddings x, and what the gradient needs."""
        zr, (gn, n, after) = np.empty((len(x), 2 * self.hidden), x.dtype), np.empty((3, len(x), self.hidden), x.dtype)
        self._gates(loops or self._loops(), h, x, zr, gn, n, after)
        return after, zr[:, : self.hidden], zr[:, self.hidden :], n, gn

    def _softmax(self, h: np.ndarray, weights: np.ndarray, targets: np.ndarray, clip: bool, out: np.ndarray, grad: np.ndarray | None, dh: np.ndarray | None) -> None:
        """Adds the log-probability of each target to out; with grad, adds to it and sets dh. Rows go in blocks whose logits stay in a core's cache."""
        width = weights.shape[1]
        if self.room is None or self.room[0].dtype != h.dtype:
            most = max(self.n_classes, PER_CLASS)
            self.room = np.empty(BLOCK * most, h.dtype), np.ones(most, h.dtype), np.arange(BLOCK)
        ones, places = self.room[1][:width], self.room[2] * width
        for a in range(0, len(targets), BLOCK):
            states, some = h[a : a + BLOCK], out[a : a + BLOCK]
            e = np.matmul(states, weights, out=self.room[0][: len(states) * width].reshape(-1, width))
            if clip:
                np.clip(e, -CLIP, CLIP, out=e)
            logits, own = e.reshape(-1), places[: len(states)] + targets[a : a + BLOCK]
            some += logits[own]
            np.exp(e, out=e)
            total = e @ ones
            some -= np.log(total)
            if grad is not None:  # by the logits it is -e / total; the division is left to the states and to dh, which are narrower
                logits[own] -= total
                share = (-1 / total)[:, None]
                grad[:-1] += (states[:, :-1] * share).T @ e
                grad[-1] += share[:, 0] @ e
                np.multiply(e @ weights[:-1].T, share, out=dh[a : a + BLOCK])

    def log_probabilities(self, h: np.ndarray, inputs: np.ndarray, grad: Network | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log P(class) * P(word | class) of the targets (input ids) from states h; with grad, d(sum)/dh and weight gradients."""
        if h.shape[1] == self.hidden:
            h = np.concatenate([h, np.ones((len(h), 1), h.dtype)], axis=1)
        cls = np.where(inputs < SHORT, inputs // PER_CLASS, self.n_ranks + inputs - SHORT)
        want = grad is not None
        out, dh = np.zeros(len(h), h.dtype), np.empty((len(h), self.hidden), h.dtype) if want else None
        # States lie between -1 and 1, which bounds logits; so that no exponential overflows
        clips = np.abs(self.to_classes).sum(0).max() > CLIP, np.abs(self.to_words).sum(1).max(1) > CLIP
        self._softmax(h, self.to_classes, cls, clips[0], out, grad.to_classes if want else None, dh)
        order = np.argsort(cls.astype(np.uint16), kind="stable")  # two bytes are sorted by radix
        edges = np.searchsorted(cls[order], np.arange(self.n_ranks + 1))
        order = order[: edges[-1]]
        states, words, more = h[order], inputs[order] % PER_CLASS, np.zeros(len(order), h.dtype)
        dstates = np.empty((len(order), self.hidden), h.dtype) if want else None
        for c in np.flatnonzero(np.diff(edges)).tolist():
            rows = slice(edges[c], edges[c + 1])
            self._softmax(states[rows], self.to_words[c], words[rows], clips[1][c], more[rows], grad.to_words[c] if want else None, dstates[rows] if want else None)
        out[order] += more
        if want:
            dh[order] += dstates
        return out, dh

    def window(self, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, grad: Network) -> tuple[float, np.ndarray]:
        """Log-likelihood of a window (time, streams) and the state after it; gradients stop at the window's begin."""
        k, (steps, streams) = self.hidden, inputs.shape
        x = np.take(self.embed, inputs, axis=0)
        stays = (~fresh).astype(h.dtype)[:, :, None]
        befores, n, gn, states = np.empty((4, steps, streams, k), h.dtype)
        zr, loops = np.empty((steps, streams, 2 * k), h.dtype), self._loops()
        for t in range(steps):
            np.multiply(h, stays[t], out=befores[t])
            self._gates(loops, befores[t], x[t], zr[t], gn[t], n[t], states[t])
            h = states[t]
        rows = np.ones((steps * streams, k + 1), h.dtype)
        rows[:, :k] = states.reshape(-1, k)
        found, dh_all = self.log_probabilities(rows, targets.reshape(-1), grad)
        dh_all = dh_all.reshape(steps, streams, k)
        dh = np.zeros_like(h)
        gx, back = x, np.ascontiguousarray(self.loop.T)  # the embeddings have been used
        by_z, by_n = befores - n, 1 - n * n
        z, r, gh = zr[:, :, :k], zr[:, :, k:], np.empty_like(x)
        rest = 1 - z
        by_n *= rest
        by_z *= z
        by_z *= rest
        by_r = 1 - r
        by_r *= r
        by_r *= gn
        for t in range(steps - 1, -1, -1):
            dh += dh_all[t]
            both, dn = gh[t], by_n[t]
            dn *= dh
            np.multiply(by_z[t], dh, out=both[:, :k])
            np.multiply(by_r[t], dn, out=both[:, k : 2 * k])
            np.multiply(dn, r[t], out=both[:, 2 * k :])
            dh *= z[t]
            dh += both @ back
            dh *= stays[t]
        gx[:, :, : 2 * k], gx[:, :, 2 * k :] = gh[:, :, : 2 * k], by_n
        grad.loop += befores.reshape(-1, k).T @ gh.reshape(-1, 3 * k)
        order = np.argsort(inputs.astype(np.uint16), axis=None, kind="stable")
        own, gx = inputs.reshape(-1)[order], np.take(gx.reshape(-1, 3 * k), order, axis=0)
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        many = np.diff(np.append(first, len(own)))
        for at in np.flatnonzero(many > MANY).tolist():
            grad.embed[own[first[at]]] += np.ones(many[at], h.dtype) @ gx[first[at] : first[at] + many[at]]
        few, one = many <= MANY, many == 1
        grad.embed[own[first[one]]] += gx[first[one]]
        few &= ~one
        rows = np.repeat(few, many)
        if few.any():
            grad.embed[own[first[few]]] += np.add.reduceat(gx[rows], np.cumsum(many[few]) - many[few], axis=0)
        return float(found.sum()), h

    @staticmethod
    def _update(flat: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, scale: float, rate: float, step: int) -> None:
        """A step along scale * g, which is used up, by the means of the gradients and of their squares; m is ten times the first, v a hundred times the second."""
        g *= scale
        m *= 0.9
        m += g
        g *= g
        v *= 0.99
        v += g
        np.sqrt(v, out=g)
        spread = 0.1 * (1 - 0.99**step) ** -0.5
        g += 1e-5 / spread
        np.divide(m, g, out=g)
        g *= 0.1 * rate / (1 - 0.9**step) / spread
        flat += g

    def train(self, vocabulary: Vocabulary, documents: list[np.ndarray], rate: float = RATE) -> int:
        """One pass over encoded documents, laid end to end in parallel streams; the number of tokens used."""
        if not documents:
            return 0
        inputs = np.concatenate([np.append(vocabulary.start, d[:-1]) for d in documents])
        targets = np.concatenate(documents)
        fresh = inputs == vocabulary.start
        streams = max(1, min(STREAMS, len(inputs) // (LEAST_STEPS * WINDOW)))  # small shares still make some steps
        length = -(-len(inputs) // streams)
        extra = streams * length - len(inputs)  # the last stream is filled up with the first tokens
        shape = lambda x: np.concatenate([x, x[:extra]]).reshape(streams, length).T
        inputs, targets, fresh = shape(inputs), shape(targets), shape(fresh)
        grad = Network(vocabulary, np.zeros_like(self.flat))
        m, v = np.zeros_like(self.flat), np.zeros_like(self.flat)
        h = np.zeros((streams, self.hidden), np.float32)
        steps = -(-length // WINDOW)
        for s in range(steps):
            at = slice(s * WINDOW, (s + 1) * WINDOW)
            grad.flat[:] = 0
            _, h = self.window(h, inputs[at], targets[at], fresh[at], grad)
            g = grad.flat
            scale = 1 / inputs[at].size
            scale /= max(1, scale * float(np.sqrt(g @ g)))
            now = rate * (1 - 0.8 * s / steps) * min(1, (s + 1) / 10)
            for p in range(0, len(g), PART):
                self._update(*(y[p : p + PART] for y in (self.flat, g, m, v)), scale, now, s + 1)
        return targets.size

    def score(self, vocabulary: Vocabulary, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log-likelihood of each encoded document (tail tokens: of their class). Documents of like length go in lockstep; their states wait for the softmax until there are SPAN of them."""
        k, out = self.hidden, np.zeros(len(documents))
        sizes = np.array([len(d) for d in documents], np.int64)
        tokens, begins = np.concatenate([*documents, np.zeros(0, np.uint16)]).astype(np.uint16), np.cumsum(sizes) - sizes
        ranked = np.argsort(-sizes, kind="stable")
        states, targets, owner = np.ones((SPAN, k + 1), np.float32), np.empty(SPAN, np.int64), np.empty(SPAN, np.int64)

        def add(n: int) -> None:
            found, _ = self.log_probabilities(states[:n], targets[:n])
            out[:] += np.bincount(owner[:n], found, len(out))

        held, loops = 0, self._loops()
        for first in range(0, len(documents), BATCH):
            rows = ranked[first : first + BATCH]
            n, at = sizes[rows], begins[rows]
            h, last = np.zeros((len(rows), k), np.float32), np.full(len(rows), vocabulary.start)
            for t, live in enumerate(np.searchsorted(-n, -np.arange(int(n[0])), side="left").tolist()):  # those with more than t tokens
                if held + live > SPAN:
                    add(held)
                    held = 0
                h = self.step(h[:live], np.take(self.embed, last[:live], axis=0), loops)[0]
                last = tokens[at[:live] + t]
                states[held : held + live, :k], targets[held : held + live], owner[held : held + live] = h, last, rows[:live]
                held += live
        add(held)
        return out


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def out() -> pa.RecordBatch:
        sums = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("c", "sum")]).combine_chunks()
        return pa.RecordBatch.from_arrays([sums.column(k).combine_chunks() for k in ("token", "c_sum")], names=["token", "c"])

    for batch in slices(batches, "text", SLICE):
        words, number, _ = split(text_bytes(batch.column("text")))
        words, c = pa.concat_arrays([words, pa.array([END], pa.binary())]), np.append(np.bincount(number, minlength=len(words)), batch.num_rows)
        held.append(pa.table({"token": words, "c": pa.array(c, pa.int64())}))
        n += len(words)
        if n > HELD_WORDS:
            yield out()
            held, n = [], 0
    if held:
        yield out()


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, c) over all texts."""
    return docs.select("text").mapInArrow(_count, "token binary, c bigint").repartition("token").groupBy("token").agg(F.sum("c").alias("c"))


def vocabulary_of(counts: DataFrame, top: int = TOP) -> Vocabulary:
    """counts: a stable table (token, c). Collects at most `top` rows, and one row for each pair of last bytes."""
    sums = counts.agg(F.sum("c"), F.count("*")).first()
    end = counts.where(F.col("token") == F.lit(END)).first()
    # The top by a bound on the count, from a histogram of its logarithm: no sort, and no task hands over more than its share.
    step = F.floor(F.log2("c") * 16)
    left, least = top - 1, None
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):  # at most 16 rows for each bit of a count
        if row["n"] > left:
            break
        left, least = left - row["n"], row["step"]
    many = counts.where(F.lit(False) if least is None else (step >= least) & (F.col("token") != F.lit(END))).toArrow()
    ranked = sorted(zip(many.column("token").to_pylist(), many.column("c").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    frequent = [(END, end["c"] if end else 0), *ranked]
    short = {w for w, _ in frequent[:SHORT]}
    pairs = counts.groupBy(F.expr("substring(token, greatest(length(token) - 1, 1), 2)").alias("e")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).toArrow()
    endings = {e: [n, v] for e, n, v in zip(*(pairs.column(k).to_pylist() for k in ("e", "n", "v")), strict=True)}
    for w, c in frequent[:SHORT]:
        if w in short and c:
            endings[w[-2:]][0] -= c
            endings[w[-2:]][1] -= 1
    return Vocabulary(frequent, {e: (n, v) for e, (n, v) in endings.items() if v}, sums[0] or 0, sums[1])


_ENCODED = "row bigint, doc_id bigint, place bigint, taught boolean, n_tokens bigint, n_known bigint, counted double, tail double, ids binary, token binary"
_COLUMNS = [x.split()[0] for x in _ENCODED.split(", ")]
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary())


def _encode(held):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, with its ids in two bytes each, and a row for each of its tokens outside the top (token not null)."""
        v: Vocabulary = held.value
        log_counts = np.log10(v.counts + 0.5)
        for batch in slices(batches, "text", SLICE):
            if not (n := batch.num_rows):
                continue
            words, number, owner = split(text_bytes(batch.column("text")))
            of_words, ranks_of = v.encode(pa.concat_arrays([words, pa.array([END], pa.binary())]))
            # Each text's words, then its end.
            sizes = np.bincount(owner, minlength=n) + 1
            edges = np.append(0, np.cumsum(sizes))
            every, place = np.full(edges[-1], len(words)), np.arange(len(number)) + owner
            every[place] = number
            # What a word adds to its text, then the sums.
            top, outside = ranks_of >= 0, of_words >= SHORT
            logs = np.where(top, log_counts[ranks_of], 0.0)
            tail = np.where(ranks_of >= v.n_short, logs, 0.0)
            tail[outside] -= v.tail_norm[of_words[outside] - SHORT]
            of_texts = lambda x: np.add.reduceat(x[every], edges[:-1])
            known, inputs, rare = of_texts((top & (v.counts[ranks_of] > 0)).astype(np.int64)), of_words.astype("<u2")[every], np.flatnonzero(~top[every])
            ids = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer((2 * edges).astype(np.int32)), pa.py_buffer(inputs)])
            columns = [*(batch.column(c) for c in _COLUMNS[:4]), pa.array(sizes), pa.array(known), pa.array(of_texts(logs)), pa.array(of_texts(tail)), ids, pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=_COLUMNS)
            if len(rare):
                empty = [pa.nulls(len(rare), t) for t in _TYPES[1:9]]
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(np.searchsorted(edges, rare, side="right") - 1)), *empty, words.take(pa.array(every[rare]))], names=_COLUMNS)

    return run


def encode(docs: DataFrame, training: Column, held) -> DataFrame:
    """docs as ids. place orders documents and deals them out, whatever their partitions; copies of a text with ids of their own are dealt out, too."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("place"), F.coalesce(training, F.lit(False)).alias("taught"), "text")
    return numbered.mapInArrow(_encode(held), _ENCODED)


def _learn(held, start, rate: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents come sorted by group; a copy of the weights for each group."""
        v, group, net, documents, n, size = held.value, None, None, [], 0, 0

        def copy() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([net.flat.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["w", "n"])

        for batch in batches:
            for g, ids in zip(batch.column("group").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if g != group:
                    if documents:
                        n += net.train(v, documents, rate)
                    if n:
                        yield copy()
                    group, net, documents, n, size = g, Network(v, start.value.copy()), [], 0, 0
                documents.append(np.frombuffer(ids, "<u2"))
                size += len(documents[-1])
                if size > 2 * GROUP_TOKENS:
                    n, documents, size = n + net.train(v, documents, rate), [], 0
        if documents:
            n += net.train(v, documents, rate)
        if n:
            yield copy()

    return run


def train(encoded: DataFrame, vocabulary: Vocabulary, held, rounds: int = ROUNDS, group_tokens: int = GROUP_TOKENS) -> np.ndarray:
    """Weights learnt from every row of encoded, once: in each round every group of documents has a copy, and the copies are averaged."""
    spark = encoded.sparkSession
    flat = Network(vocabulary).flat
    groups = max(1, min(MOST_GROUPS, -(-vocabulary.total // (rounds * group_tokens))))
    for r in range(rounds):
        start = spark.sparkContext.broadcast(flat)
        mine = encoded.where(F.pmod("place", F.lit(rounds)) == r).select(F.pmod(F.xxhash64("place"), F.lit(groups)).alias("group"), "place", "doc_id", "ids")
        copies = written(mine.repartitionById(groups, F.col("group").cast("int")).sortWithinPartitions("group", "place", "doc_id", "ids").mapInArrow(_learn(held, start, RATE / (1 + r)), "w binary, n bigint"), "weights")
        while (k := copies.count()) > 32:
            copies, before = written(copies.repartition(-(-k // 32)).mapInArrow(_mean, "w binary, n bigint"), "weights"), copies
            discard(before)
        rows = copies.collect()  # at most 32 copies
        discard(copies)
        if rows:
            flat = sum(np.frombuffer(x["w"], np.float32).astype(float) * x["n"] for x in rows) / sum(x["n"] for x in rows)
            flat = flat.astype(np.float32)
    return flat


def _mean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for batch in batches:
        for w, k in zip(batch.column("w").to_pylist(), batch.column("n").to_pylist(), strict=True):
            x = np.frombuffer(w, np.float32).astype(float) * k
            total, n = (x if total is None else total + x), n + k
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([(total / n).astype(np.float32).tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["w", "n"])


_KEPT = ("row", "doc_id", "n_tokens", "n_known", "counted", "tail")


def _score(held, weights):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = held.value
        net = Network(v, weights.value)

        def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            logs = net.score(v, [np.frombuffer(x, "<u2") for x in table.column("ids").to_pylist()]) / np.log(10)
            return pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks() for c in _KEPT), pa.array(logs)], names=[*_KEPT, "modelled"])

        parts, size = [], 0
        for batch in slices(batches, "ids", HELD):
            parts.append(batch)
            size += batch.column("ids").nbytes // 2
            if size > HELD:
                yield done(parts)
                parts, size = [], 0
        if parts:
            yield done(parts)

    return run


def language_model_scores(docs: DataFrame, training: Column, rounds: int = ROUNDS, top: int = TOP, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every text; training says which rows are learnt from."""
    spark = docs.sparkSession
    counts = written(count_tokens(docs.where(training)), "token-counts")
    vocabulary = vocabulary_of(counts, top)
    held = spark.sparkContext.broadcast(vocabulary)
    encoded = written(encode(docs, training, held), "encoded")
    whole = encoded.where("token IS NULL")
    weights = spark.sparkContext.broadcast(train(whole.where("taught"), vocabulary, held, rounds, group_tokens))
    modelled = whole.select(*_KEPT, "ids").mapInArrow(_score(held, weights), "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, counted double, tail double, modelled double")
    rare = encoded.where("token IS NOT NULL").select("row", "token").join(counts, "token", "left")
    sums = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare"), F.count_if(F.col("c") > 0).alias("rare_known"))
    joined = modelled.join(sums, "row", "left")
    extra = F.coalesce("rare", F.lit(0.0))
    norm = float(np.log10(vocabulary.total + 0.5 * (vocabulary.types + 1)))
    return joined.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"), F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("counted") + extra - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("modelled") + F.col("tail") + extra).alias("score"),
    )
