"""Groups of near copies: texts whose sets of word shingles have a Jaccard similarity of at least ``LEAST``, and all that are linked over such pairs.

Equal sets are folded first. Fingerprints of close texts meet in the SimHash trie, and each group it finds is held against one of its
members. Two sets of similarity 0.8 differ in about ten of 64 bits, which no trie can afford, so the rest comes from prefixes: with
shingles in one fixed order, two similar sets share one among their first n - ceil(LEAST * n) + 1. The order puts frequent shingles
last, so that common lines make no candidates; whatever the order, no pair is lost. Texts that share such a shingle are held against
one of them, ``ROUNDS`` times, then members of different groups so far against each other, in blocks of ``BLOCK``. Sizes, places of the shared shingle, and
a sketch of ``BITS`` parity bits, whose differing bits never outnumber the differing shingles, bound the overlap of a pair from above. So few bits rule out
nothing for large sets, which have a second sketch of one or two bits for each shingle, a 64th to a 32nd of the set.
Pairs that pass there aren't listed: they only say which texts belong to a class, a row for each text at most. The large sketches of a class meet in blocks,
which leaves smaller classes. Their whole sets then meet in blocks,
and what leaves a task are links that join groups, fewer than its rows. Every link is an exact comparison of the whole sets (of 64-bit hashes).

Two passes read the texts: one for set digests, fingerprints and frequent shingles, one for prefixes and sketches. The whole sets are made
again only for texts that take part in a pair.

Defined cases: words are what ``simhash`` takes for words; texts of fewer words than a shingle have one shingle of all their words; null and
empty texts have the empty set and are copies of one another; pairs at exactly ``LEAST`` are links; rows that repeat a key are one text;
very long texts are taken whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from ..tables import discard
from . import simhash
from .common import partitions_for, slices, small_batches, text_bytes, written

SHINGLE, LEAST = 5, 0.8
#: Shingles whose counts go to the tasks, a bound; only the order depends on it.
FREQUENT = 100_000
HELD = 2_000_000
BITS, BLOCK = 1024, 4096
#: Texts, and shingles of their sets, in a block of those that are compared whole.
CLASS_BLOCK, CLASS_SHINGLES = 1024, 4_000_000
#: 64-bit words of sketches in a block of those that are compared by them.
SKETCH_WORDS = 4_000_000
#: How often a shingle's members are held against one of them before the rest of their pairs are.
ROUNDS = 2


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's distinct shingles, ascending."""
    return np.unique(simhash.shingle_hashes(text, shingle))


def sketch(own: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity bits, a power of two of them: each shingle turns over one. Half as many are the two halves, XORed."""
    odd = np.bincount((own >> np.uint64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).view(np.uint64)


def width(n: int) -> int:
    """Bits of the sketch of a set of n shingles, at least one for each."""
    return max(BITS, 1 << (n - 1).bit_length()) if n else BITS


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text its key, the digest of its set and its fingerprint; for each shingle that a task sees three times or more its count (key null)."""
    held, size = [], 0

    def often() -> pa.RecordBatch:
        s, c = np.unique(np.concatenate(held), return_counts=True)
        s, c = s[c > 2], c[c > 2]
        none = [pa.nulls(len(s), t) for t in (pa.int64(), pa.binary(), pa.int64())]
        return pa.RecordBatch.from_arrays([*none, pa.array(s.view(np.int64)), pa.array(c.astype(np.int64))], names=["key", "set", "fp", "s", "c"])

    for batch in slices(batches, "text"):
        sets, fps = [], []
        for t in text_bytes(batch.column("text")):
            hashes = simhash.shingle_hashes(t, SHINGLE)
            own = np.unique(hashes)
            sets.append(xxhash.xxh3_128_digest(own.tobytes()))
            fps.append(simhash.majority(hashes))
            held.append(own)
            size += len(own)
        none = [pa.nulls(len(sets), pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sets, pa.binary()), pa.array(fps, pa.int64()), *none], names=["key", "set", "fp", "s", "c"])
        if size > HELD:
            yield often()
            held, size = [], 0
    if held:
        yield often()


def frequent(counted: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """At most `most` frequent shingles, ascending, and their counts. counted: (s, c), several rows for a shingle."""
    counts = written(counted.groupBy("s").agg(F.sum("c").alias("c")), "frequent")
    step = F.floor(F.log2("c") * 16)
    left, least = most, None
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if row["n"] > left:
            break
        left, least = left - row["n"], row["step"]
    found = counts.where(F.lit(False) if least is None else step >= least).toArrow()
    s, c = (found.column(k).to_numpy() for k in ("s", "c"))
    order = np.argsort(s.view(np.uint64))
    return s.view(np.uint64)[order], c[order]


def prefix(own: np.ndarray, common: np.ndarray, counts: np.ndarray, least: float = LEAST) -> np.ndarray:
    """The shingles among which every similar set has one, too: rare before frequent, then by hash."""
    rank = np.zeros(len(own), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        rank = np.where(common[at] == own, counts[at], 0)
    return own[np.lexsort((own, rank))][: len(own) - ceil(least * len(own) - 1e-9) + 1]


def _heads(held):
    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = held.value
        for batch in slices(batches, "text"):
            sizes, bits, wide, heads = [], [], [], []
            for t in text_bytes(batch.column("text")):
                own = shingle_set(t)
                sizes.append(len(own))
                bits.append(sketch(own).view(np.int64))
                wide.append(sketch(own, width(len(own))).view(np.int64) if len(own) > BITS else None)
                heads.append(prefix(own, common, counts).view(np.int64))
            edges = np.cumsum([0, *map(len, heads)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(heads)))
            words = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * (BITS // 64)), pa.array(np.concatenate(bits)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int32()), words, pa.array(wide, pa.list_(pa.int64())), lists], names=["key", "n", "bits", "wide", "prefix"])

    return make


def needed(n, m):
    """The overlap that two similar sets of these sizes have at least."""
    return np.ceil(LEAST / (1 + LEAST) * (n + m) - 1e-9)


def _largest():
    return F.coalesce("wide", "bits")


def _apart(a: str, b: str):
    """Differing bits of two sketches, of which one may be twice as long."""
    half = lambda w: F.transform(F.slice(w, F.lit(1), (F.size(w) / 2).cast("int")), lambda x, i: x.bitwiseXOR(F.element_at(w, i + 1 + (F.size(w) / 2).cast("int"))))
    x, y = (F.when(F.size(p) > F.size(q), half(F.col(p))).otherwise(F.col(p)) for p, q in ((a, b), (b, a)))
    return F.aggregate(F.zip_with(x, y, lambda v, w: F.bit_count(v.bitwiseXOR(w))), F.lit(0), lambda t, v: t + v)


def _needed(n: str, m: str):
    return F.ceil(F.lit(LEAST / (1 + LEAST)) * (F.col(n) + F.col(m)) - 1e-9)


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = [shingle_set(t).view(np.int64) for t in text_bytes(batch.column("text"))]
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]).astype(np.int32)), pa.array(np.concatenate(sets)))
        yield pa.RecordBatch.from_arrays([batch.column("key"), lists], names=["key", "own"])


def similar(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    pairs = written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    taking = written(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct(), "taking")
    own = written(rows.join(taking, "key", "left_semi").mapInArrow(_sets, "key bigint, own array<bigint>"), "own")
    sets = own.dropDuplicates(["key"])
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))  # in the JVM, a pair at a time: batches of whole sets would be large
    found = written(both.where(common >= (LEAST - 1e-12) * (F.size("x") + F.size("y") - common)).select("a", "b"), "similar")
    discard(pairs, taking, own)
    return found


def _blocks(batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.Table]:
    """The rows of each value of the columns, by which they come sorted."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = [batch.column(k).to_numpy() for k in names]
        new = np.zeros(max(batch.num_rows - 1, 0), bool)
        for k in keys:
            new |= k[1:] != k[:-1]
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for p, q in zip(cuts, cuts[1:], strict=False):
            if q > p and held and tuple(held[-1].column(k)[0].as_py() for k in names) != tuple(k[p] for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            if q > p:
                held.append(batch.slice(p, q - p))
    if held:
        yield pa.Table.from_batches(held)


def _close(bits: np.ndarray, n: np.ndarray, k: int, at: np.ndarray) -> np.ndarray:
    """Those of the rows `at` whose sketches leave room for similarity to row k."""
    return at[np.bitwise_count(bits[at] ^ bits[k]).sum(1, dtype=np.int64) <= n[k] + n[at] - 2 * needed(n[k], n[at])]


def _across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shingle and pair of blocks. Edges (a, b) whose closure holds every pair of different groups (c) that may be similar: at most one for each row, from the smallest key of its class."""
    for table in _blocks(batches, ("s", "x", "y")):
        key, n, i, c, block = (table.column(k).to_numpy() for k in ("key", "n", "i", "c", "block"))
        bits = table.column("bits").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(key), -1)
        mixed = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        label = np.arange(len(key))
        for k in range(1, len(key)):
            other = slice(0, k)
            need = needed(n[k], n[other])
            may = (label[other] != label[k]) & (c[other] != c[k]) & (need <= np.minimum(n[k], n[other])) & (need <= np.minimum(n[k] - i[k], n[other] - i[other]))
            if mixed:
                may &= block[other] != block[k]
            at = np.flatnonzero(may)
            if len(at) and len(at := _close(bits, n, k, at)):
                label[np.isin(label, label[at])] = label[k]
        yield from _forest(key, label)


def _forest(key: np.ndarray, label: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from the smallest key of each label to its others."""
    order = np.lexsort((key, label))
    first = np.flatnonzero(np.append(True, np.diff(label[order]) != 0))
    least = np.repeat(key[order[first]], np.diff(np.append(first, len(key))))
    apart = least != key[order]
    if apart.any():
        yield pa.RecordBatch.from_arrays([pa.array(least[apart]), pa.array(key[order][apart])], names=["a", "b"])


def _sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by class and pair of blocks, with their largest sketches (w). Edges as of _across."""
    for table in _blocks(batches, ("class", "x", "y")):
        order = np.argsort(table.column("n").to_numpy(), kind="stable")  # larger sets have larger sketches
        key, n, c, block = (table.column(k).to_numpy()[order] for k in ("key", "n", "c", "block"))
        lists = table.column("w").combine_chunks()
        words = np.split(lists.flatten().to_numpy().view(np.uint64), np.cumsum(pa.compute.list_value_length(lists).to_numpy())[:-1])
        words = [words[k] for k in order]
        edges = [0, *(np.flatnonzero(np.diff([len(w) for w in words])) + 1).tolist(), len(words)]
        alike = [np.stack(words[p:q]) for p, q in zip(edges, edges[1:], strict=False)]
        mixed = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        label = np.arange(len(key))
        for level, (p, q) in enumerate(zip(edges, edges[1:], strict=False)):
            for k in range(p, q):
                low = int(np.searchsorted(n[:k], LEAST * n[k] - 1))
                need = needed(n[k], n[low:k])
                may = (label[low:k] != label[k]) & (c[low:k] != c[k]) & (need <= n[low:k])
                if mixed:
                    may &= block[low:k] != block[k]
                at, found = np.flatnonzero(may) + low, []
                for of in range(level, -1, -1):  # two sizes of sketches at most, as similar sets go
                    mine, own = at[(at >= edges[of]) & (at < edges[of + 1])], words[k]
                    if len(mine):
                        while len(own) > alike[of].shape[1]:
                            own = own[: len(own) // 2] ^ own[len(own) // 2 :]
                        differing = np.bitwise_count(alike[of][mine - edges[of]] ^ own).sum(1, dtype=np.int64)
                        found.append(mine[differing <= n[k] + n[mine] - 2 * needed(n[k], n[mine])])
                close = np.concatenate(found) if found else at
                if len(close):
                    label[np.isin(label, label[close])] = label[k]
        yield from _forest(key, label)


def _within(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by class and pair of blocks, with whole sets. Links (a, b) between similar sets of different groups (c) that join them: a row less than there are groups, at most."""
    for table in _blocks(batches, ("class", "x", "y")):
        key, c, block = (table.column(k).to_numpy() for k in ("key", "c", "block"))
        lists = table.column("own").combine_chunks()
        sets = np.split(lists.flatten().to_numpy().view(np.uint64), np.cumsum(pa.compute.list_value_length(lists).to_numpy())[:-1])
        mixed = table.column("x")[0].as_py() != table.column("y")[0].as_py()
        _, label, sizes = np.unique(c, return_inverse=True, return_counts=True)
        order = np.lexsort((label, -sizes[label]))  # a group that most belong to first, so that its members aren't held against each other
        key, label, block, sets = key[order], label[order], block[order], [sets[k] for k in order]
        n, bits = np.array([len(x) for x in sets]), np.stack([sketch(x) for x in sets])
        a, b = [], []
        for k in range(int((label == label[0]).sum()), len(key)):
            need = needed(n[k], n[:k])
            may = (label[:k] != label[k]) & (need <= np.minimum(n[k], n[:k]))
            if mixed:
                may &= block[:k] != block[k]
            at = np.flatnonzero(may)
            at = _close(bits, n, k, at) if len(at) else at
            while len(at):
                other, at = int(at[0]), at[1:]
                place = np.minimum(np.searchsorted(sets[other], sets[k]), n[other] - 1)
                common = int((sets[other][place] == sets[k]).sum())
                if common >= (LEAST - 1e-12) * (n[k] + n[other] - common):
                    a.append(key[other])
                    b.append(key[k])
                    label[label == label[other]] = label[k]
                    at = at[label[at] != label[k]]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _dealt(rows: DataFrame, by: str, blocks) -> DataFrame:
    """A row for each pair (x, y) of blocks of its group in which its own is, sorted by group and pair."""
    tasks = partitions_for(rows.sparkSession, rows.count(), 100_000)
    dealt = rows.withColumn("_blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key"), "_blocks")).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    dealt = dealt.withColumns({"x": F.least("block", "o"), "y": F.greatest("block", "o")}).drop("o", "_blocks")
    return dealt.repartition(tasks, by, "x", "y").sortWithinPartitions(by, "x", "y")


def _classes(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """key, class (what hangs together by the edges) and group (c) of the rows that have an edge."""
    classes = components(edges).join(groups.toDF("node", "c"), "node", "left").select(F.col("node").alias("key"), F.col("component").alias("class"), F.coalesce("c", "node").alias("c"))
    return written(classes, "classes")


def refined(edges: DataFrame, groups: DataFrame, sketches: DataFrame) -> DataFrame:
    """Edges whose classes hold every pair of different groups that may be similar by its largest sketches, among those in one class of edges."""
    classes = _classes(edges, groups)
    held = written(sketches.select("key", "n", _largest().alias("w")).join(classes, "key"), "class-sketches")
    sizes = held.groupBy("class").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.size("w")) / SKETCH_WORDS)).alias("blocks"))
    with small_batches(sketches.sparkSession):
        found = written(_dealt(held.join(sizes, "class"), "class", F.col("blocks")).drop("blocks").mapInArrow(_sketched, "a bigint, b bigint"), "refined")
    discard(classes, held)
    return found


def joining(edges: DataFrame, groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) of similar sets that join all groups with a similar pair inside a class, which is what hangs together by the edges. A text is sent whole once for each block of its class, and the links are never more
    than the rows that are compared."""
    classes = _classes(edges, groups)
    own = written(rows.join(classes.select("key"), "key", "left_semi").mapInArrow(_sets, "key bigint, own array<bigint>"), "own")
    held = written(own.dropDuplicates(["key"]).join(classes, "key"), "class-sets")
    sizes = held.groupBy("class").agg(F.ceil(F.greatest(F.count("*") / CLASS_BLOCK, F.sum(F.size("own")) / CLASS_SHINGLES)).alias("blocks"))
    with small_batches(rows.sparkSession):
        found = written(_dealt(held.join(sizes, "class"), "class", F.col("blocks")).drop("blocks").mapInArrow(_within, "a bigint, b bigint"), "joining")
    discard(classes, own, held)
    return found


def _mixed(shared: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of shingles whose members are in several groups so far, with the group as c. Groups only grow, so rows that are left out once stay out; shared is removed."""
    found = components(links).withColumnRenamed("node", "key")
    grouped = shared.select("s", "key", "n", "i", "members").join(found, "key", "left").select("s", "key", "n", "i", "members", F.coalesce("component", "key").alias("c"))
    apart = grouped.groupBy("s").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("s")
    mixed = written(grouped.join(apart, "s", "left_semi"), "mixed")
    discard(shared)
    return mixed


def near_copies(docs: DataFrame) -> DataFrame:
    """(key, group) of every row. docs: key, which tells different texts apart, and text; group is the key of one of its members."""
    rows, spark = docs.select("key", "text"), docs.sparkSession
    made = written(rows.mapInArrow(_digests, "key bigint, set binary, fp bigint, s bigint, c bigint"), "digests")
    members = written(made.where("set IS NOT NULL").select("key", "set", "fp"), "members")
    reps = written(members.groupBy("set").agg(F.min("key").alias("rep"), F.first("fp").alias("fp")), "sets")
    held = spark.sparkContext.broadcast(frequent(made.where("s IS NOT NULL").select("s", "c")))
    discard(made)
    heads = rows.mapInArrow(_heads(held), "key bigint, n int, bits array<bigint>, wide array<bigint>, prefix array<bigint>").join(reps.select(F.col("rep").alias("key")), "key", "left_semi")
    heads = written(heads.dropDuplicates(["key"]), "prefixes")

    fps = written(reps.groupBy("fp").agg(F.min("rep").alias("rep")), "fingerprints")
    named = reps.join(simhash.classes(fps), "fp")
    center = named.groupBy("class").agg(F.min("rep").alias("a"))
    met = named.join(center, "class").where("rep <> a").select("a", F.col("rep").alias("b"))

    listed = heads.select("key", "n", F.posexplode("prefix").alias("i", "s"))
    many = listed.groupBy("s").agg(F.count("*").alias("members")).where("members > 1")
    mixed = written(listed.join(many, "s"), "shared")
    sketches = written(heads.select("key", "n", "bits", "wide"), "sketches")
    largest = sketches.select("key", _largest().alias("w"))
    discard(heads)
    links = similar(met, rows)
    discard(fps)
    for r in range(ROUNDS):
        mixed = _mixed(mixed, links)
        pivot = mixed.groupBy("s").agg(F.min_by(F.struct("key", "n", "i", "c"), F.xxhash64("key", F.lit(r))).alias("p")).select("s", F.col("p.key").alias("a"), F.col("p.n").alias("m"), F.col("p.i").alias("j"), F.col("p.c").alias("d"))
        fits = _needed("n", "m") <= F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))
        star = mixed.join(pivot, "s").where((F.col("c") != F.col("d")) & fits).select("a", F.col("key").alias("b"), "n", "m").distinct()
        star = star.join(largest.toDF("a", "wa"), "a").join(largest.toDF("b", "wb"), "b").where(_apart("wa", "wb") <= F.col("n") + F.col("m") - 2 * _needed("n", "m")).select("a", "b")
        links = links.unionByName(similar(star, rows))
    mixed = _mixed(mixed, links)
    met = mixed.select("s", "key", "n", "i", "c", "members").join(sketches.select("key", "bits"), "key")
    edges = _dealt(met, "s", F.ceil(F.col("members") / BLOCK)).drop("members").mapInArrow(_across, "a bigint, b bigint")
    grouped = components(links)
    found = components(links.unionByName(joining(refined(edges, grouped, sketches), grouped, rows)))
    discard(mixed, sketches)
    return members.join(reps.select("set", "rep"), "set").join(found, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("component", "rep").alias("group"))
