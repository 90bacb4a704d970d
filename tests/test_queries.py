"""Every query against its SQL in DuckDB, as the driver compares them."""

import os

import duckdb
import pytest

from aerolith import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, db, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    if name not in queries.SQL:
        assert len(got)
        return
    want = db.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(want.columns)
    a, b = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b)
    for c in columns:
        x, y = a[c].replace({"None": "nan", "<NA>": "nan", "NaT": "nan"}), b[c].replace({"None": "nan", "<NA>": "nan", "NaT": "nan"})
        assert (x == y).all(), (c, x[x != y].head(3).tolist(), y[x != y].head(3).tolist())
