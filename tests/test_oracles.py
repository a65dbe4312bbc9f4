"""Every registered query with SQL against DuckDB at the smallest size."""

import glob
import math
import os

import duckdb
import pytest

from framewise.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def text(v):
    return ("nan" if math.isnan(v) else repr(v + 0.0)) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted("|".join(text(r[c]) for c in columns) for r in df.collect())
    found = duck.execute(ORACLES[name])
    at = {d[0]: k for k, d in enumerate(found.description)}
    assert sorted(at) == columns
    assert got == sorted("|".join(text(r[at[c]]) for c in columns) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
