"""What the operators of this subpackage share: the shared folder, written tables, words and sentences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import new_path, shared_dir, written

#: White space between words: space and U+0009 to U+000D, nothing else.
ASCII_SPACE = " \t\n\x0b\x0c\r"

__all__ = ["ASCII_SPACE", "DOCUMENT_COLUMNS", "lowest_hashes", "new_path", "partitions_for", "remainder", "shared_dir", "slices", "small_batches", "table", "text_bytes", "words_of", "written"]

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, modulus: int):
    """crc32 of the id as text, modulo; a null id counts as remainder -1, so it is in no held-out fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(-1))


def lowest_hashes(df: DataFrame, key: str, most: int) -> DataFrame:
    """The `most` rows whose keys hash lowest. A bound on the hash, from the row count, comes first, so that tasks together hand over about
    `most` rows and not each as many."""
    rows = df.count()
    h = F.xxhash64(key)
    if rows > 2 * most:
        df = df.where(h <= int(-(1 << 63) + (1 << 64) * (1.5 * most + 1000) / rows)) if 1.5 * most + 1000 < rows else df
    return df.orderBy(h, key).limit(most)


def partitions_for(spark: SparkSession, rows: int, per_task: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text: bytes.split() separates exactly at space and U+0009 to U+000D."""
    return text.split() if text else []


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000, most_bytes: int | None = None) -> Iterator[None]:
    """Arrow batches of fewer rows, or of about so many bytes, for what is written inside, where rows carry whole texts beside lists."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows} | ({"spark.sql.execution.arrow.maxBytesPerBatch": most_bytes} if most_bytes else {})
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a slice holds a bounded amount of text, or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column).cast(pa.large_binary())).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            total += size or 0
            if total >= most_bytes:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < len(sizes):
            yield batch.slice(start)
