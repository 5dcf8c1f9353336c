import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera.llm import collocations as C

DOCS = "doc_id bigint, text string, lang string, n bigint, phrase string, rank int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=100, longest=5, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            f = counts.setdefault(lang, Counter())
            for k in range(1, longest + 1):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {(p[i : i + k], a) for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)}
        rows = []
        for p, a in found.items():
            if any((p, b) in inside for b in (a,)):
                continue
            s, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def run(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, lang, 1, "x", 2) for i, (t, lang) in enumerate(rows)], DOCS)
    return sorted(tuple(r) for r in C.collocations(docs, **more).collect())


def corpus(seed, n, words=25):
    r = random.Random(seed)
    vocabulary = [*(f"w{i}" for i in range(words)), "É", "é", "A", "a\x01", "a", "ⅷ", "x y", "<b>"]
    fixed = ["the quick brown fox jumps over", "in order to", "aa aa aa aa aa aa aa", "as well as as well as"]
    def text():
        out = []
        for _ in range(r.randint(0, 12)):
            out.append(r.choice(fixed) if r.random() < 0.3 else " ".join(r.choices(vocabulary, k=r.randint(1, 9))))
            out.append(r.choice([".", ", ", "\n", " ", "\t", "!? ", "\r\n", "\x0b"]))
        return "".join(out)
    return [(text() if r.random() < 0.95 else r.choice([None, "", " .,", "\n"]), r.choice(["en", "de", None, "und", "é"])) for _ in range(n)]


@pytest.mark.parametrize(("seed", "least", "longest", "top"), [(0, 3, 5, 2000), (1, 8, 5, 20), (2, 2, 4, 7), (3, 30, 5, 2000)])
def test_equals_brute_force(spark, monkeypatch, seed, least, longest, top):
    monkeypatch.setattr(C, "ROWS", 64)
    rows = corpus(seed, 150)
    want = brute(rows, least, longest, top)
    assert want and run(spark, rows, least=least, longest=longest, top=top) == want


def test_shards_and_cuts_don_t_change_counts(spark, monkeypatch):
    rows = [*corpus(5, 60), (" ".join(["deep river"] * 500) + "." + "deep river, " * 300, "en")]
    made = C.shards(spark.createDataFrame([(t, lang) for t, lang in rows], "text string, lang string").repartition(3), most=300, waiting=500)
    found = C.phrases(made, C.shards(spark.createDataFrame([(t, lang) for t, lang in rows], "text string, lang string")).selectExpr("lang", "explode(words) word").distinct(), least=5, bits=12)
    got = {(r.lang, r.phrase): r.a for r in found.collect()}
    counts = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            counts.update((lang or "und", " ".join(words[i : i + k])) for k in range(2, 6) for i in range(len(words) - k + 1))
    assert got == {p: a for p, a in counts.items() if a >= 5}


def test_a_full_bit_table_changes_no_result(spark):
    rows = corpus(7, 60)
    docs = spark.createDataFrame([(t, lang) for t, lang in rows], "text string, lang string")
    words = C.shards(docs).selectExpr("lang", "inline(arrays_zip(words, counts))").groupBy("lang", "words").sum("counts").where("`sum(counts)` >= 4").selectExpr("lang", "words as word")
    few, many = (sorted(map(tuple, C.phrases(C.shards(docs), words, least=4, bits=b).collect())) for b in (6, 22))
    assert few == many and few


def test_bitmaps_hold_the_positions():
    row = {n: c[0] for n, c in C.shard("en", b"a b a. a c  a\tb;;b").to_pydict().items()}
    blocks, bits = np.cumsum(np.frombuffer(row["blocks"], "<i4")), np.frombuffer(row["bits"], "<u2")
    at, found = 0, {}
    for word, k in zip(row["words"], row["blocks_of"], strict=True):
        found[word] = [16 * int(blocks[j]) + i for j in range(at, at + k) for i in range(16) if bits[j] >> i & 1]
        at += k
    assert found == {"a": [0, 2, 4, 6], "b": [1, 7, 9], "c": [5]} and row["n"] == 8 and row["counts"] == [4, 3, 1]
    assert C.shard("en", b" .,\n") is None


def test_cuts_end_pieces():
    r = random.Random(1)
    for _ in range(200):
        buffer = bytes(r.choice(b"aaaabc .") if r.random() < 0.9 else 0x2E for _ in range(r.randint(0, 200))) if r.random() < 0.8 else b"a" * 150 + b"." + b"b" * 30
        parts = list(C.cuts(buffer, 20))
        assert b"".join(parts) == buffer
        assert all(p[-1:] == b"." for p in parts[:-1])


def test_only_live_words_take_part():
    """Words of which no bit is set have no rows, so no step is made for them."""
    row = {n: c[0] for n, c in C.shard("en", b"a b c a b d").to_pydict().items()}
    table = np.zeros(1 << 6, np.uint64)
    for h in C.word_hashes("en", ["a", "b"]).tolist():
        bit = h >> 52
        table[bit >> 6] |= np.uint64(1 << (bit & 63))
    maps = C.Bitmaps(row | {"blocks_of": np.array(row["blocks_of"])}, table)
    live = C.maybe(table, C.word_hashes("en", row["words"]))
    assert live[:2].all() and set(maps.word.tolist()) == set(np.flatnonzero(live).tolist())


def test_a_phrase_grows_only_from_frequent_parts():
    """Of what is counted by hash, nothing has a part that is surely rare."""
    text = (b"a b c. " * 5 + b"a b d. b d e f. c d e. ") * 2
    row = {n: c[0] for n, c in C.shard("en", text).to_pydict().items()}
    row["blocks_of"] = np.array(row["blocks_of"])
    every = np.full(1 << 14, np.uint64(2**64 - 1))
    by_hash = {}
    for size, parent, last, hashes, counts in C.grown(C.Bitmaps(row, every), [every, every, every], 4):
        by_hash |= dict(zip(hashes.tolist(), zip([size] * len(counts), counts.tolist(), strict=True), strict=True))
    few = np.zeros(1 << 14, np.uint64)
    for h, (size, n) in by_hash.items():
        if size == 2 and n >= 10:
            bit = h >> 44
            few[bit >> 6] |= np.uint64(1 << (bit & 63))
    assert sorted(n for s, n in by_hash.values() if s == 3) == [2, 2, 2, 2, 10]
    assert [n for _, counts in C.hashed_counts(row, [every, few], 3) for n in counts.tolist()] == [10]


def test_products_beyond_64_bits(spark):
    big = spark.createDataFrame([(10**15, 10**16, 10**15 + 1, 10**15 + 3)], "a bigint, n bigint, l bigint, r bigint").withColumn("s", C.F.expr(C.SCORE))
    assert big.collect()[0].s == 1000 * 10**15 * 10**16 // ((10**15 + 1) * (10**15 + 3)) and dict(big.dtypes)["s"] == "bigint"


def test_long_texts_and_empty_tables(spark):
    rows = [("alpha beta " * 60_000, "en"), ("gamma. " * 50, "en"), ("alpha beta", None), (None, "fr")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(None, None), ("", "en")]) == []


def test_ties_go_by_bytes(spark):
    rows = [(f"{a} {b}.", "en") for a, b in (("z", "y"), ("é", "x"), ("b", "c"), ("a\x01", "q"), ("a", "q2")) for _ in range(3)]
    assert [r[2] for r in run(spark, rows, least=3)] == [r[2] for r in brute(rows, 3)]


@pytest.mark.parametrize("least", [3, 10])
def test_oracle_with_a_smaller_bound(spark, least):
    rows = corpus(11, 80)
    c = duckdb.connect()
    c.register("documents", pa.Table.from_pandas(pd.DataFrame({"text": pd.Series([t for t, _ in rows], dtype=object), "lang": pd.Series([x for _, x in rows], dtype=object)})))
    assert sorted(tuple(r) for r in c.execute(C.oracle(least)).fetchall()) == run(spark, rows, least=least)


def test_a_task_holds_few_shards(spark, monkeypatch):
    """The groups of rows of the shards' table are of bounded size, however many shards a task makes."""
    r = random.Random(3)
    docs = spark.createDataFrame([(" ".join(f"w{r.randrange(9000)}" for _ in range(400)), "en") for _ in range(150)], "text string, lang string").coalesce(1)
    sizes, shards, written = [], C.shards, C.written

    def seen(df, name, *more):
        out = written(df, name, *more)
        if name == "bitmaps":
            for path in Path(out.written_to).glob("*.parquet"):
                meta = pq.ParquetFile(path).metadata
                sizes.extend((meta.row_group(k).num_rows, meta.row_group(k).total_byte_size) for k in range(meta.num_row_groups))
        return out

    monkeypatch.setattr(C, "shards", lambda d: shards(d, 1 << 11, 1 << 12))
    monkeypatch.setattr(C, "GROUP_BYTES", 1 << 16, raising=False)
    monkeypatch.setattr(C, "written", seen)
    C.collocations(docs).collect()
    assert sum(n for n, _ in sizes) > 100 and max(size for _, size in sizes) < 1 << 18


def test_hashes_are_summed_by_bucket_before_they_leave_a_task():
    r = np.random.default_rng(5)
    h, c = r.integers(0, 1 << 44, 5000, np.uint64), r.integers(1, 9, 5000)
    batch = C.bucketed([(h, c), (h, c)], 10)
    assert batch.num_rows == len({int(x) >> 32 for x in h})
    got = {(b << 32) + (x & 0xFFFFFFFF): n for b, low, many in zip(*(batch[k].to_pylist() for k in ("bucket", "low", "c")), strict=True) for x, n in zip(low, many, strict=True)}
    assert got == {int(x): min(2 * int(n), 10) for x, n in zip(h, c, strict=True)}


def test_phrases_are_summed_before_they_leave_a_task(spark):
    """A phrase that all shards of a task have leaves it once, in the row of its bucket: there was a row for each shard and phrase."""
    rows = [("one two three four. five six", "en"), ("one two three four", None)] * 60
    docs = spark.createDataFrame([(i, t, lang, None, None, None) for i, (t, lang) in enumerate(rows)], DOCS)
    made = C.written(C.shards(docs.coalesce(1), most=64, waiting=256).coalesce(1), "bitmaps")
    assert made.count() > 20
    words = made.select("lang", C.F.explode("words").alias("word")).distinct()
    found = C.phrases(made, words, least=2)
    assert {(x.lang, x.phrase, x.size): x.a for x in found.collect()} == {(lang, p, len(p.split())): n for lang, more in (("en", ["five six"]), ("und", [])) for p in ["one two", "two three", "three four", "one two three", "two three four", "one two three four", *more] for n in [60]}
    counts = [pa.table({"lang": [lang], "phrase": [p], "size": pa.array([2], pa.int32()), "c": [n]}) for _ in range(50) for lang, p, n in (("en", "a b", 3), ("de", "a b", 1), ("en", "c d", 5))]
    out = C.folded(counts)
    assert out.num_rows <= 2 and sorted((x["lang"], x["phrase"], x["size"], x["c"]) for row in out["counts"].to_pylist() for x in row) == [("de", "a b", 2, 50), ("en", "a b", 2, 150), ("en", "c d", 2, 250)]


def test_sums_of_tasks_meet_by_bucket(spark):
    """Counts that tasks send are summed as they come, bucket after bucket: none becomes a row of its own; there was a row for each task and phrase."""
    r = random.Random(4)
    tables = [pa.table({"lang": [r.choice(["en", "de"]) for _ in range(300)], "phrase": [f"a {r.randrange(150)}" for _ in range(300)], "size": pa.array([2] * 300, pa.int32()), "c": [r.randint(1, 5) for _ in range(300)]}) for _ in range(20)]
    rows = sorted((row for t in tables for row in C.folded([t]).to_pylist()), key=lambda x: x["bucket"])
    schema = C.folded(tables[:1]).schema
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 7], schema) for k in range(0, len(rows), 7)]
    want = Counter()
    for t in tables:
        for x in t.to_pylist():
            want[x["lang"], x["phrase"]] += x["c"]
    for most in (1, 50, 10**6):
        out = list(C.met([*batches, batches[0].slice(0, 0)], 50, most))
        found = [((x["lang"], x["phrase"]), x["a"]) for b in out for x in b.to_pylist()]
        assert len(found) == len(dict(found)) and dict(found) == {p: n for p, n in want.items() if n >= 50} and len(out) > (most < 100)
    assert list(C.met([], 1, 1)) == []
    docs = spark.createDataFrame([("one two three four. five six", "en")] * 40, "text string, lang string")
    made = C.written(C.shards(docs.repartition(4)), "bitmaps")
    plan = C.phrases(made, made.select("lang", C.F.explode("words").alias("word")).distinct(), least=2)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
