"""Queries over rendered sentences on orders whose keys look like years, which the smallest tables don't have."""

from __future__ import annotations

import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from docweave import plans


@pytest.fixture(scope="module")
def later(spark, small, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("later"))
    for name in ("customer", "nation", "region"):
        shutil.copy(f"{small}/{name}.parquet", f"{at}/{name}.parquet")
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").where(F.col("o_orderkey").between(1890, 2110))
    orders.coalesce(1).write.parquet(f"{at}/orders.parquet")
    return at


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="needs the next larger tables")
@pytest.mark.parametrize("name", ["ner_counts", "span_extraction", "ner_rows", "span_labels", "span_kinds", "firm_names", "number_normalisation"])
def test_rows_of_sql(spark, later, name):
    con = duckdb.connect()
    con.sql(f"create view orders as select * from read_parquet('{later}/orders.parquet/*.parquet')")
    got = plans.queries()[name](spark, later)
    want = con.sql(plans.oracles()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted(want.select(*[f'"{c}"' for c in columns]).fetchall(), key=repr)
