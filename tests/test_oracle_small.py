"""Spark result == DuckDB oracle on the sf0.001 tables for a sample of queries."""

import os
import sys

import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_oracle import TABLES, digest  # noqa: E402

SAMPLE = ["movements", "ingredients", "sales", "dim_sync", "slice_replace_deaths", "form_extract",
          "budget_actuals", "catalog_flatten", "metric_math"]


@pytest.fixture(scope="module")
def duck(small_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{small_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_duckdb(spark, small_dir, duck, name):
    sdf = E.queries()[name](spark, small_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(sdf.columns, s_rows)[0] == digest(d_cols, d_rows)[0]
