"""From raw documents to packed training sequences: five stages, each written as Parquet and read again as the next one's input.

Every stage but the last returns the columns of documents, whatever other columns its input has; an empty table gives no rows; very long texts are taken
whole. What else is defined for each stage stands beside it, and beside the operator that it calls.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import near_copies, packing, quality, quality_rules, repeats
from tessera.llm.common import DOCUMENT_COLUMNS, remainder, table, written

#: SQL can't express training, fingerprints, repeats or byte-pair encoding; tests hold the stages against brute force.
ORACLE_SQL = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps. Null and empty texts have features like any other; repeated rows are kept or dropped alike; a score of exactly the threshold is kept."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    return quality.score(docs, quality.train(docs, labels)).where("kept").select(*DOCUMENT_COLUMNS)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule. Null and empty texts have no words and go; a measure that equals its threshold passes or fails as the rule has it; repeated rows are kept or dropped alike."""
    return quality_rules.quality_rules(docs.select(*DOCUMENT_COLUMNS)).where("kept").select(*DOCUMENT_COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies: Jaccard similarity of 5-word shingles of at least 0.8, linked.

    Rows are told apart by a hash of id and text, so rows that share an id stay both unless their texts are near copies, and of rows that repeat both one
    stays. Null and empty texts are copies of one another. A null id comes after all others; among equal ids the hash decides.
    """
    keyed = docs.select(*DOCUMENT_COLUMNS, F.xxhash64("doc_id", "text").alias("_key"), F.crc32(F.col("text").cast("binary")).alias("_check"))
    groups = near_copies.near_copies(keyed.select(F.col("_key").alias("key"), "text")).withColumnRenamed("key", "_key").distinct()
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key")
    kept = keyed.select("doc_id", "_key").join(groups, "_key").groupBy("group").agg(F.min(place).alias("first")).select("first._key")
    return keyed.join(kept, "_key").dropDuplicates(["_key", "doc_id", "_check"]).select(*DOCUMENT_COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the long strings that also start earlier; a null text becomes empty. Rows that repeat id and text are one document, and keep the same. All documents stay, even those with nothing left."""
    left = repeats.remove_repeats(docs.select(*DOCUMENT_COLUMNS))
    return left.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}).select(*DOCUMENT_COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences; an empty text is a piece of its end id alone, and every row is packed, repeated ones too."""
    return packing.best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", classify), ("quality rules", apply_rules), ("simhash near-dedup", drop_near_copies), ("suffix-array dedup", cut_repeats), ("best-fit packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = written(stage(spark, out, sf_dir), name.replace(" ", "-"))
    return out
