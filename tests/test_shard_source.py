import random

import pytest

from tessera.operators import shards
from tessera.sources import readers, sinks
from tessera.sources.shard_source import shard_order, token_windows, windows_of
from tessera.tables import new_path, written


@pytest.fixture(scope="module")
def folder(spark):
    """Shards of 100 tokens and less; the last has the length of a whole number of windows and one."""
    r = random.Random(1)
    out = new_path(spark, "shards")
    rows = [(k, 0, [r.randrange(60_000) for _ in range(n)]) for k, n in enumerate([100, 100, 37, 100, 5, 6, 11, 31])]
    sinks.write_shards(spark.createDataFrame(rows, "shard int, at int, tokens array<int>"), out, "train", vocabulary=60_000)
    return out


def rows(df):
    return sorted((x.epoch, x.turn, x.file, x.start, tuple(x.x), tuple(x.y)) for x in df.collect())


def want(spark, folder, seq_len, epochs, seed):
    table = written(readers.binary_shards(spark, folder).withColumnRenamed("file", "shard"), "shards")
    by_shard = {}
    for w in shards.train_windows(table, seq_len).collect():
        by_shard.setdefault(w.shard, []).append((w.start, tuple(w.x), tuple(w.y)))
    out = []
    for e in range(epochs):
        every = [(f, *w) for f in shard_order([x.shard for x in table.collect()], e, seed) for w in sorted(by_shard.get(f, []))]
        out += [(e, k, *w) for k, w in enumerate(every)]
    return sorted(out)


@pytest.mark.parametrize(("seq_len", "per_task", "epochs"), [(5, 4096, 1), (5, 3, 3), (10, 1, 2), (99, 7, 1), (1000, 5, 1)])
def test_windows_by_range(spark, folder, seq_len, per_task, epochs):
    got = token_windows(spark, folder, seq_len=seq_len, windows_per_task=per_task, epochs=epochs, seed=7)
    assert rows(got) == want(spark, folder, seq_len, epochs, 7)


def test_epochs_differ_and_cover_the_same(spark, folder):
    got = token_windows(spark, folder, seq_len=10, epochs=2).collect()
    order = {e: [x.file for x in sorted(got, key=lambda x: x.turn) if x.epoch == e and x.start == 0] for e in (0, 1)}
    assert order[0] != order[1] and sorted(order[0]) == sorted(order[1])


def test_windows_of():
    for n in range(60):
        for s in (1, 5, 10):
            assert windows_of(n, s) == len([k for k in range(0, n, s) if k + s + 1 < n])


def test_the_stream_gives_the_same_and_goes_on(spark, folder):
    out, state = new_path(spark, "out"), new_path(spark, "state")
    options = {"seq_len": 10, "epochs": 3, "seed": 5, "shards_per_batch": 5}

    def batch(df, batch_id):
        df.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def run(until):
        query = token_windows(spark, folder, stream=True, **options).writeStream.foreachBatch(batch).option("checkpointLocation", state).start()
        try:
            for _ in range(600):
                query.awaitTermination(0.2)
                if query.lastProgress and query.lastProgress["batchId"] >= until:
                    break
        finally:
            query.stop()

    run(1)
    run(4)
    got = spark.read.schema("epoch int, turn bigint, file string, start bigint, x array<int>, y array<int>, batch int").parquet(out)
    assert rows(got) == want(spark, folder, 10, 3, 5) and got.select("batch").distinct().count() >= 4


def test_a_cut_shard_is_an_error(spark, folder):
    out = new_path(spark, "shards")
    sinks.write_shards(spark.createDataFrame([(0, 0, list(range(50)))], "shard int, at int, tokens array<int>"), out, "train", vocabulary=60_000)
    with open(f"{out.removeprefix('file://')}/shard_00000_train.bin", "r+b") as f:
        f.truncate(20)
    with pytest.raises(Exception, match="ends before its manifest"):
        token_windows(spark, out, seq_len=10).collect()
