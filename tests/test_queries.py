"""Registered queries against their SQL on the small tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from docweave import plans

@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for p in glob.glob(f"{small}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(plans.oracles()))
def test_rows_of_sql(spark, small, con, name):
    got = plans.queries()[name](spark, small)
    want = con.sql(plans.oracles()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted((plain(r) for r in want.select(*[f'"{c}"' for c in columns]).fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
