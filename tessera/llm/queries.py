"""The registered queries of this subpackage: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import spread
from . import bpe_automaton as _bpe
from . import byte_bpe as _byte_bpe
from . import collocations as _collocations
from . import language_model as _lm
from . import nearest as _nearest
from . import packing as _packing
from . import quality as _quality
from . import quality_rules as _rules
from . import repeats as _repeats
from . import simhash as _simhash
from . import spelling as _spelling
from . import toxicity as _toxicity
from . import warc as _warc
from .common import remainder, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels come only from rows whose remainder is not 2."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    scored = _toxicity.score(docs, _toxicity.train(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= _toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", _simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _warc.archive_and_read(spread(table(spark, sf_dir, "pages")), least=0)


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels come only from rows whose remainder is not 2."""
    docs = documents(spark, sf_dir)
    model = _quality.train(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2))
    return _quality.score(docs, model).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "content_score", "metadata_score", "score", "kept")


def op5_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return _nearest.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return _rules.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_recurrent_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = _lm.language_model_scores(docs, remainder("doc_id", 5) != 1)
    return found.select("doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bpe.bpe_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op9_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return _repeats.remove_repeats(docs, kept="sha256").withColumnRenamed("kept", "kept_sha256")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = _packing.best_fit_packing(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _byte_bpe.digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_bitmap_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collocations.collocations(documents(spark, sf_dir).select("lang", "text"))


def op13_wavelet_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spelling.variants(documents(spark, sf_dir).select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_simhash, op3_warc, op4_cotraining, op5_adaptive_scan, op6_quality_rules, op7_recurrent_model, op8_bpe_automaton, op9_run_length_index, op10_best_fit_packing, op11_two_tier_bpe, op12_bitmap_phrases, op13_wavelet_variants)}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": _warc.oracle(), "op6_quality_rules": _rules.oracle(), "op9_run_length_index": _repeats.oracle(), "op12_bitmap_phrases": _collocations.oracle()}
