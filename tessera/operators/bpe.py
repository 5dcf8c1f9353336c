"""Token counts for vocabularies, a given tokenizer as a checked artifact, and encoding by it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..tables import qualified

_LOADED: dict[str, object] = {}


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of lower-cased words: what a vocabulary is built from. Counted in part before the shuffle."""
    return docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\S+)"), F.lit(1))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def store_tokenizer(spark: SparkSession, path: str, folder: str, end: str = "<|endoftext|>") -> dict:
    """Puts a given tokenizer file into a folder, with a manifest: tokens, hash and id of the end token. A file that isn't a tokenizer, or doesn't know the end token, is an error and stores nothing."""
    from tokenizers import Tokenizer

    from ..sources.sinks import file_system, write_json

    with open(path, encoding="utf-8") as f:
        content = f.read()
    made = Tokenizer.from_str(content)
    end_id = made.token_to_id(end)
    if end_id is None:
        raise ValueError(f"{path} has no token {end}")
    manifest = {"schema": 1, "kind": "tokenizer", "tokens": max(made.get_vocab(True).values()) + 1, "end": end, "end_id": end_id}
    fs, at = file_system(qualified(spark, folder))
    fs.create_dir(at, recursive=True)
    write_json(spark, f"{folder}/tokenizer.json", json.loads(content))
    with fs.open_input_stream(f"{at}/tokenizer.json") as f:
        manifest["sha256"] = hashlib.sha256(f.read()).hexdigest()
    write_json(spark, f"{folder}/tokenizer.manifest.json", manifest)
    return manifest


def load_tokenizer(spark: SparkSession, folder: str) -> tuple[str, dict]:
    """(content, manifest) of a stored tokenizer; an error if it isn't there, or isn't what its manifest says."""
    from ..sources.sinks import file_system

    fs, at = file_system(qualified(spark, folder))
    try:
        with fs.open_input_stream(f"{at}/tokenizer.manifest.json") as f:
            manifest = json.loads(f.read())
        with fs.open_input_stream(f"{at}/tokenizer.json") as f:
            content = f.read()
    except FileNotFoundError as e:
        raise FileNotFoundError(f"no tokenizer in {folder}: store one first") from e
    if hashlib.sha256(content).hexdigest() != manifest["sha256"]:
        raise ValueError(f"the tokenizer in {folder} isn't the one that was stored")
    return content.decode(), manifest


def encode_rows(rows: DataFrame, content: str, end_id: int, text: str = "text") -> DataFrame:
    """rows with tokens array<int> in place of the text, an end id after each; rows whose text has no tokens are left out. The tokenizer's content is sent to the tasks."""
    held = rows.sparkSession.sparkContext.broadcast(content)
    key = hashlib.sha256(content.encode()).hexdigest()
    kept = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        if key not in _LOADED:
            _LOADED[key] = Tokenizer.from_str(held.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [[*e.ids, end_id] if e.ids else None for e in _LOADED[key].encode_batch_fast([t or "" for t in part.column(text).to_pylist()], add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(ids, pa.list_(pa.int32()))], names=[*kept, "tokens"])

    schema = rows.select(*kept).schema.add("tokens", T.ArrayType(T.IntegerType()))
    return rows.select(*kept, text).mapInArrow(run, schema).where("tokens IS NOT NULL")


def encode_documents(docs: DataFrame, path: str, eos_id: int, id_column: str = "doc_id") -> DataFrame:
    """(id, tokens) of texts with their end id; texts without tokens are left out."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    return encode_rows(docs.select(F.col(id_column).cast("long").alias("id"), "text"), content, eos_id)
