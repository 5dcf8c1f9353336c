import os
import random

from tessera.operators import reports


def test_domain_report_of_a_hot_domain(spark):
    """One domain with most pages, some with few, and pages without a domain, over several salts."""
    r = random.Random(2)
    rows = [("hot" if r.random() < 0.7 else r.choice([None, *(f"d{i}" for i in range(9))]), i, r.random()) for i in range(900)]
    pages = {}
    for domain, _, score in rows:
        pages.setdefault(domain, []).append(score)
    got = {x.domain: (round(x.avg_score, 9), x.n_pages) for x in reports.domain_report(spark.createDataFrame(rows, "domain string, ord bigint, score double"), salts=7).collect()}
    assert got == {d: (round(sum(s[-20:]) / len(s[-20:]), 9), len(s)) for d, s in pages.items()}


def test_stream_gate_over_many_batches(spark):
    """A hot domain and others, a file a batch in the order of the rows: the gate of all of them together."""
    from tessera.operators import gate
    from tessera.streaming import stateful
    from tessera.tables import new_path

    r = random.Random(5)
    rows = [(i, "hot" if r.random() < 0.6 else f"d{i % 5}", r.random() * (0.9 if i < 700 else 0.25)) for i in range(1200)]
    df = spark.createDataFrame(rows, "ord bigint, domain string, score double")
    source, out = new_path(spark, "in"), new_path(spark, "out")
    df.repartitionByRange(8, "ord").write.parquet(source)
    names = sorted(f"{source.removeprefix('file://')}/{x}" for x in os.listdir(source.removeprefix("file://")) if x.startswith("part-"))
    for k, name in enumerate(names):  # the file source takes files by age
        os.utime(name, (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    gated = stateful.gate(stream, chunk=7)
    gated.writeStream.outputMode("append").option("checkpointLocation", new_path(spark, "state")).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    got = {(x.domain, x.ord): x.admitted for x in spark.read.schema(gated.schema).parquet(out).collect()}
    want = {(x.domain, x.ord): x.admitted for x in gate.signal_gate(df).collect()}
    assert got == want and {False, True} == set(want.values())
