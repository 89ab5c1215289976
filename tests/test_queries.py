"""Every registered query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from tilewright.plans import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _key(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)

    def show(v) -> str:
        if v is None or v is pd.NA or v != v:
            return "null"
        return repr(float(v) + 0.0) if isinstance(v, (int, float, np.number)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(map(show, r)) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in SQL:
        assert len(got)
        return
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _key(got) == _key(want)
