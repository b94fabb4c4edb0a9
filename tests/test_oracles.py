"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import collections
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare_oracles import TABLES, rows_of  # noqa: E402

from pagelake.plans.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    srows, scols = rows_of(df.columns, df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    orows, ocols = rows_of([d[0] for d in res.description], res.fetchall())
    assert scols == ocols
    assert len(srows) > 0
    assert collections.Counter(srows) == collections.Counter(orows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "_rowHash" in df.columns and "has_ts" in df.columns
