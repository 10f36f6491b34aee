"""Every registered query against its DuckDB text on the smallest test tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
import oracle
from tidemark import registry

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables not present")

QUERIES, ORACLES = registry.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    got = [tuple(r[c] for c in order) for r in df.collect()]
    want = [tuple(dict(zip(columns, r))[c] for c in order) for r in result.fetchall()]
    key = lambda row: tuple((v is not None, v if v is not None else 0) for v in row)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry_has_rows(spark):
    df = driver.entry(spark)
    assert df.columns == ["industry", "country", "plan_tier", "churned_mrr", "revenue_loss_rank"]
    assert df.count() > 0
