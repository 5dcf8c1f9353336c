import json
import math
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.operators import bpe, language
from tessera.plans import stages
from tessera.sources import readers
from tessera.tables import new_path

TEXTS = {
    "en": ["the quick brown fox jumps over the lazy dog and then the other one", "this is the story of a house that stood near the river", "there were three things that they wanted"],
    "de": ["der schnelle braune fuchs springt über den faulen hund und dann", "dies ist die geschichte von einem haus das an dem fluss stand", "es gab drei dinge die sie haben wollten"],
    "fr": ["le renard brun rapide saute par dessus le chien paresseux et puis", "c'est l'histoire d'une maison qui était près de la rivière", "il y avait trois choses qu'ils voulaient"],
}


def grams(text):
    head = " " + re.sub(r"[^\w]|\d|_", lambda m: " ", (text or "")[:2000].lower()) + " "
    head = re.sub(" +", " ", head)
    return [head[i : i + 3] for i in range(len(head) - 2)]


def brute(known, asked, most=1000):
    counts = {}
    for text, lang in known:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    kinds = len(set().union(*counts.values()))
    kept = {g for c in counts.values() for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:most]}
    out = {}
    for key, text in asked:
        own = [g for g in grams(text) if g in kept]
        scores = {lang: round(sum(math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * (kinds + 1))) for g in own), 6) for lang, c in counts.items()}
        out[key] = min(scores, key=lambda x: (-scores[x], x)) if own else None
    return out


@pytest.mark.parametrize("most", [1000, 12])
def test_detection_equals_brute_force(spark, most):
    known = [(t, lang) for lang, texts in TEXTS.items() for t in texts] + [(None, "de"), ("no language", None), ("", "fr")]
    asked = [(i, t) for i, t in enumerate(["the dog", "der hund", "le chien", "", None, "12 34 !?", "zzzz qqqq", "THE HOUSE, and the river!", "Das Haus", "la maison d'une " * 4000])]
    model = language.fit(spark.createDataFrame(known, "text string, lang string"), most=most)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in asked], "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.detected for r in language.detect(docs, model).collect()}
    assert got == brute(known, asked, most)
    kept = {r.doc_id for r in language.english_only(docs, model).collect()}
    assert kept == {i for i, lang in got.items() if lang in (None, "en")}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    found = language.detect(docs.where("doc_id % 4 = 0"), language.fit(docs.where("doc_id % 4 <> 0"))).join(docs.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL")
    right, n = found.select(F.sum((F.col("detected") == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.95 * n


def test_without_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    model = language.fit(none)
    assert model.collect() == [] and language.detect(none, model).collect() == []
    assert [tuple(r) for r in language.detect(spark.createDataFrame([(1, "text")], "doc_id bigint, text string"), model).collect()] == [(1, None)]


PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_a_stored_tokenizer_is_loaded_or_fails(spark, tmp_path):
    folder = new_path(spark, "tokenizer")
    with pytest.raises(FileNotFoundError, match="store one first"):
        bpe.load_tokenizer(spark, folder)
    with pytest.raises(ValueError, match="no token <none>"):
        bpe.store_tokenizer(spark, PATH, folder, "<none>")
    manifest = bpe.store_tokenizer(spark, PATH, folder)
    assert (manifest["tokens"], manifest["end_id"]) == (50_257, 50_256)
    content, again = bpe.load_tokenizer(spark, folder)
    assert again == manifest and json.loads(content)["model"]["type"] == "BPE"
    (tmp_path / "broken.json").write_text("{}")
    with pytest.raises(Exception):  # noqa: B017
        bpe.store_tokenizer(spark, str(tmp_path / "broken.json"), new_path(spark, "tokenizer"))
    with open(f"{folder.removeprefix('file://')}/tokenizer.json", "a") as f:
        f.write(" ")
    with pytest.raises(ValueError, match="isn't the one"):
        bpe.load_tokenizer(spark, folder)


def test_a_run_with_a_tokenizer(spark):
    """Shards of ids by a stored tokenizer, read back, are the library's ids with the end id after each text; a run without its tokenizer ends before its first stage."""
    from tokenizers import Tokenizer

    r = ["plain words about %d rivers and %d towns that were described at length here" % (i, i * 7) + f" and number{i}" * (i % 5) for i in range(40)]
    docs = spark.createDataFrame([(f"d{i}", t, float(1)) for i, t in enumerate(r)], "doc_id string, text string, final_weight double").withColumn("ord", F.substring("doc_id", 2, 9).cast("long"))
    folder, tokenizer = new_path(spark, "run"), new_path(spark, "tokenizer")
    config = stages.RunConfig(tokenizer=tokenizer, val_fraction=0.1, shard_size=300, enabled=("tokenize", "shard"), seed=3)
    rows = docs.withColumn("copy_no", F.lit(0))
    with pytest.raises(FileNotFoundError):
        stages.run(spark, rows, folder, config, config.enabled)
    bpe.store_tokenizer(spark, PATH, tokenizer)
    with pytest.raises(ValueError, match="50257 tokens"):
        stages.run(spark, rows, folder, stages.RunConfig(tokenizer=tokenizer, bits=8, enabled=("tokenize", "shard")), config.enabled)
    packed = stages.run(spark, rows, folder, config, config.enabled)
    out = new_path(spark, "shards")
    stages.export_shards(packed, out, config)
    library = Tokenizer.from_file(PATH)
    found = [t for x in sorted(readers.binary_shards(spark, out).collect(), key=lambda x: (x.file.rsplit("_", 1)[1], x.file)) for t in x.tokens]
    texts, own = [], []
    for t in found:
        if t == 50_256:
            texts.append(tuple(own))
            own = []
        else:
            own.append(t)
    assert not own and sorted(texts) == sorted(tuple(library.encode(t, add_special_tokens=False).ids) for t in r)


def test_no_gram_becomes_a_row(spark):
    """Detection neither explodes texts nor shuffles."""
    docs = spark.createDataFrame([(i, "the dog and the cat " * 50, "en") for i in range(20)], "doc_id bigint, text string, lang string")
    plan = language.detect(docs, language.fit(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_whole_texts_and_all_grams_and_languages_count(spark):
    """What tells languages apart may stand after any number of characters, be rare, and be of any of many languages."""
    shared = "aaa bbb " * 400  # 3,200 characters
    names = [f"l{k:02d}" for k in range(70)]
    own = {x: chr(0x4E00 + 3 * k) * 3 for k, x in enumerate(names)}
    common = " ".join(chr(97 + a) + chr(97 + b) + chr(97 + c) for a in range(12) for b in range(12) for c in range(12)) * 2  # over 1,000 grams that all have more often
    docs = [(k, x, shared + common + " " + own[x]) for k, x in enumerate(names)]
    model = language.fit(spark.createDataFrame(docs, "doc_id bigint, lang string, text string"))
    asked = spark.createDataFrame([(k, shared + own[x]) for k, x in enumerate(names)], "doc_id bigint, text string")
    assert {r.doc_id: r.detected for r in language.detect(asked, model).collect()} == dict(enumerate(names))


def test_slices_and_pieces_give_the_same(spark, monkeypatch):
    known = [(t, lang) for lang, texts in TEXTS.items() for t in texts]
    asked = [(i, t) for i, t in enumerate(["the dog", "der hund", "le chien", "", None, "zzzz qqqq", "Das Haus " * 50, "la maison d'une " * 40])]
    docs = spark.createDataFrame(asked, "doc_id bigint, text string")
    want = brute(known, asked)
    monkeypatch.setattr(language, "ENTRIES", 100)
    monkeypatch.setattr(language, "PIECE", 7)
    model = language.fit(spark.createDataFrame(known, "text string, lang string"))
    assert model.count() > 300
    assert {r.doc_id: r.detected for r in language.detect(docs, model).collect()} == want
