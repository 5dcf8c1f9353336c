import hashlib
import os
import random
import threading

from pyspark.sql import functions as F

from tessera.operators import schedule
from tessera.plans import sessions, store
from tessera.tables import new_path


def test_two_writers_lose_no_update(spark):
    """Each of three writers sets stages of its own session, four times, all at once."""
    log = store.SessionStore(spark, new_path(spark, "sessions"))
    ids = [log.create(f"n{i}") for i in range(3)]
    assert ids == [1, 2, 3]
    failed = []

    def write(i):
        try:
            own = store.SessionStore(spark, log.folder)
            for stage in ("crawl", "clean", "dedupe", "weight"):
                own.update(spark.createDataFrame([(i, stage, f"by {i}")], "dataset_id bigint, stage string, status string"))
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in ids]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and log.version() == 3 + 12
    for r in log.read().collect():
        assert all(r.stages[s] == f"by {r.dataset_id}" for s in ("crawl", "clean", "dedupe", "weight"))
    assert [log.entry(v)["upon"] for v in range(1, 16)] == list(range(15))


def test_a_conflict_makes_the_change_again(spark):
    log = store.SessionStore(spark, new_path(spark, "sessions"))
    log.create("a")
    tried = []

    def slow(old):
        tried.append(old.count())
        if len(tried) == 1:
            store.SessionStore(spark, log.folder).create("b")  # comes first
        return old.withColumn("status", F.lit("seen"))

    assert log.commit(slow) == 3 and tried == [1, 2]
    assert {(r.name, r.status) for r in log.read().collect()} == {("a", "seen"), ("b", "seen")}
    assert {r.status for r in log.read(2).collect()} == {"NOT_STARTED"} and log.read(0).count() == 0


def test_versions_and_defaults(spark):
    log = store.SessionStore(spark, new_path(spark, "sessions"))
    log.create("  ", None)
    r = log.read().first()
    assert (r.name, r.group_id, r.status) == ("Dataset-1", "custom", "NOT_STARTED") and set(r.stages.values()) == {"pending"}
    try:
        log.update(spark.createDataFrame([(9, "crawl", "complete")], "dataset_id bigint, stage string, status string"))
        raise AssertionError
    except KeyError as e:
        assert e.args == (9,)
    assert log.version() == 1
    assert not store.put_if_absent(spark, f"{log.folder}/log/{1:012d}.json", {})


def test_files_are_copied_and_failures_have_rows(spark, tmp_path):
    source, folder = tmp_path / "in", tmp_path / "raw"
    (source / "sub").mkdir(parents=True)
    (source / "a.txt").write_bytes(b"alpha")
    (source / "sub" / "b.bin").write_bytes(bytes(range(256)) * 1000)
    (source / "empty").write_bytes(b"")
    paths = [f"file:{p}" for p in sorted(source.rglob("*")) if p.is_file()]
    files = spark.createDataFrame([(p,) for p in [*paths, f"file:{source}/gone.txt", f"file:{source}/sub", f"file:{tmp_path}/elsewhere"]], "path string").repartition(3)
    manifest, errors = sessions.copy_in(files, str(source), str(folder))
    got = {r.path: (r.sha256, r.size) for r in manifest.collect()}
    assert got == {p: (hashlib.sha256((source / p).read_bytes()).hexdigest(), (source / p).stat().st_size) for p in ("a.txt", "sub/b.bin", "empty")}
    assert sorted(r.source.rsplit("/", 1)[-1] for r in errors.collect()) == ["elsewhere", "gone.txt", "sub"] and all(r.error for r in errors.collect())
    assert sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file()) == ["a.txt", "empty", "sub/b.bin"]
    assert (folder / "sub" / "b.bin").read_bytes() == (source / "sub" / "b.bin").read_bytes() and not [p for p in os.listdir(folder) if p.startswith(".")]


def test_schedule_equals_a_loop(spark):
    """One hot host over all ranges, many small ones, and requests without a host."""
    r = random.Random(3)
    rows = [("hot" if r.random() < 0.6 else r.choice([None, *(f"h{i}" for i in range(9))]), i, r.randrange(200_000), r.choice([0, 500, 1000, 7000])) for i in range(900)]
    want, last = {}, {}
    for host, i, ready, wait in rows:
        start = max(ready, last[host]) if host in last else ready
        want[i], last[host] = start, start + wait
    got = schedule.start_times(spark.createDataFrame(rows, "host string, ord bigint, ready bigint, wait bigint").repartition(3))
    assert {x.ord: x.start for x in got.collect()} == want
    assert schedule.start_times(spark.createDataFrame([], "host string, ord bigint, ready bigint, wait bigint")).collect() == []


def test_waits(spark):
    rows = [(200, 0, None, 1000), (429, 0, 7, 7000), (429, 1, None, 4000), (None, 0, None, 1000), (None, 2, None, 4000), (404, 1, 5, 1000)]
    got = spark.createDataFrame(rows, "status int, attempt int, after int, want long").select(schedule.wait_after(F.col("status"), F.col("attempt"), F.col("after")).alias("got"), "want").collect()
    assert [x.got for x in got] == [x.want for x in got]
