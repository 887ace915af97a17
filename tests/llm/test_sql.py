"""Registered queries with an oracle against DuckDB on the smallest tables."""

import glob
from pathlib import Path

import pytest

from cohortry.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {Path(p).stem} as select * from read_parquet('{p}')")
    con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in con.description]
    want = sorted(con.fetchall(), key=str)
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == want
