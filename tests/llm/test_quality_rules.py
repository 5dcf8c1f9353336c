import random

import duckdb

from tessera.llm import quality_rules as Q

DOCS = "doc_id bigint, text string, kept string, n_words int, note string"


def slow(text):
    text = text or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if any(c not in " \t\x0b\x0c\r" for c in x)]
    wins = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def cases():
    r = random.Random(1)
    out = [None, "", " \n\t", "a", "é\x85ü b", "a b c d e a b c d e", "a a a a a a a", "x\n\nx\n \nx", "#*|<> $%&", "the " * 40, "w " * 3000, "one\vtwo\ftwo\rthree"]
    for _ in range(120):
        out.append("".join(r.choice(["a ", "b ", "the ", "\n", "# ", "é ", "c\t"]) for _ in range(r.randint(0, 80))))
    return out


def test_measures_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "clash", 5, "n") for i, t in enumerate(cases())] + [(None, "null id", "", 0, None)], DOCS)
    found = Q.quality_rules(docs)
    assert found.columns.count("kept") == 1 and "note" in found.columns and "text" in found.columns
    for x in found.where("doc_id IS NOT NULL").collect():
        want = slow(cases()[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want, cases()[x.doc_id]
        assert x.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (x.kept and x.base_failed)


def test_filter_on_the_verdict_stays_above_the_measures(spark):
    docs = spark.createDataFrame([(i, t, "", 0, "") for i, t in enumerate(cases())], DOCS)
    plan = Q.quality_rules(docs).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("xxhash64")
    assert "Python" not in plan and "Exchange" not in plan


def test_oracle(spark):
    import pandas as pd

    frame = pd.DataFrame({"doc_id": range(len(cases())), "text": cases()})
    c = duckdb.connect()
    c.register("documents", frame)
    want = sorted(map(tuple, c.execute(Q.oracle()).fetchall()))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = Q.quality_rules(spark.createDataFrame([(i, t, "", 0, "") for i, t in enumerate(cases())], DOCS)).select(*names)
    assert sorted(map(tuple, got.collect())) == want


def test_inner_names(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over one lazy dog near the river", "x", "y", 3)], "doc_id int, text string, _words string, _row string, n_lines int")
    assert Q.quality_rules(docs).where("kept").first().n_lines == 1


def test_empty(spark):
    assert Q.quality_rules(spark.createDataFrame([], DOCS)).collect() == []
