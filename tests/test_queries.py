"""Every registered query with an oracle against DuckDB on the smallest tables."""

import glob
import math
from pathlib import Path

import pytest

from cohortry.plans.all_queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {Path(p).stem} as select * from read_parquet('{p}')")
    return con


def rows(frame):
    blank = lambda x: x is None or x != x or (isinstance(x, float) and math.isnan(x))
    return sorted(tuple("" if str(x) == "<NA>" or blank(x) else str(x) for x in r) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(ORACLES[name]).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["user_id", "decision", "message"]
