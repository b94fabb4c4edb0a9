"""The queries that SQL can express, against DuckDB."""

import collections
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from compare_oracles import rows_of  # noqa: E402

from pagelake.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    found = con.execute(ORACLES[name])
    rows, columns = rows_of(df.columns, df.collect())
    expected, names = rows_of([d[0] for d in found.description], found.fetchall())
    assert columns == names
    assert collections.Counter(rows) == collections.Counter(expected)
