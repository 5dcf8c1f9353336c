import pyarrow as pa
import pytest

from tessera.llm import common as C


def test_slices_hold_bounded_text():
    texts = ["x" * n for n in (0, 5, 100, 3, 3, 3)] + [None, "y" * 50]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "text"])
    parts = list(C.slices([batch, batch.slice(0, 0)], "text", 10))
    assert [x for p in parts for x in p.column("i").to_pylist()] == list(range(len(texts)))
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()[:-1]) < 10 for p in parts if p.num_rows)


@pytest.mark.parametrize(("rows", "most"), [(0, 5), (3, 5), (20_000, 300), (20_000, 19_999)])
def test_lowest_hashes(spark, rows, most):
    df = spark.range(rows)
    want = [r.id for r in df.orderBy(C.F.xxhash64("id"), "id").limit(most).collect()]
    assert [r.id for r in C.lowest_hashes(df, "id", most).collect()] == want


def test_words():
    assert C.words_of("a\x85b c \td\n".encode()) == ["a\x85b c".encode(), b"d"]
    assert C.words_of(None) == [] == C.words_of(b"")
