import duckdb
import pytest

from tessera.plans import queries as Q
from tessera.plans import loop_queries, source_queries  # noqa: F401

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(str(round(v, 6) if isinstance(v, float) else v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, sf, duck, name):
    got = Q.QUERIES[name](spark, sf).toPandas()
    if name in Q.ORACLES:
        assert rows(got) == rows(duck.execute(Q.ORACLES[name]).df())


@pytest.mark.parametrize(("name", "columns"), [("doc_text_stats", {"doc_id", "text"}), ("english_documents", {"doc_id", "lang"}), ("exact_dedup_clean", {"doc_id", "text"}), ("upsample", {"doc_id"})])
def test_scans_read_only_what_they_need(spark, sf, name, columns):
    import re

    plan = Q.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert {c.split(":")[0] for c in schema.split(",") if c} <= columns


def test_simple_filters_reach_the_scan(spark, sf):
    plan = Q.crawl.top_per_group(Q.table(spark, sf, "orders").where("o_custkey > 5"), ["o_custkey"], [Q.F.col("o_orderkey")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_custkey), GreaterThan(o_custkey,5)]" in plan
