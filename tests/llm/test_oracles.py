import duckdb
import pandas as pd
import pytest

from tessera.llm import queries as Q


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_oracle(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = c.execute(Q.oracle_sql()[name]).df()
    got = Q.queries()[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda df: sorted(tuple("null" if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v) for v in r) for r in df[columns].itertuples(index=False))
    assert rows(got) == rows(want)
