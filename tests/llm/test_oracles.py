"""The operators that SQL can express against their DuckDB oracles on the smallest data set."""

import os

import duckdb
import pytest

from carelake.llm.registry import ORACLES, QUERIES
from scripts.check_oracles import digest
from tests.llm.data import SF


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        p = os.path.join(SF, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert len(rows) == len(want) and digest(df.columns, rows) == digest(cols, want)
