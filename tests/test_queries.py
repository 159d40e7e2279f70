"""Every registered query against its DuckDB oracle on the smallest data set
(row count, column names, order-insensitive value hash)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from carelake.plans import registry
from scripts.check_oracles import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver data not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["origid", "last_visit", "visit_due", "days_since"]


def test_every_query_has_an_oracle():
    missing = set(registry.QUERIES) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    drows = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert len(rows) == len(drows)
    assert digest(df.columns, rows) == digest(dcols, drows)
