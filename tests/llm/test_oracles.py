"""Queries that SQL can express, against DuckDB over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from quizmill.llm.oracle import ORACLES
from quizmill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for f in Path(SMALL).glob("*.parquet"):
        duck.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    theirs = duck.execute(ORACLES[name])
    columns = [c[0] for c in theirs.description]
    want = sorted(map(str, theirs.fetchall()))
    assert sorted(map(str, map(tuple, QUERIES[name](spark, SMALL).select(*columns).collect()))) == want and len(want) > 100
