"""SURVEY §5 layer 1, in-suite: every registered query equals its DuckDB oracle at sf0.001
(the driver repeats this at sf0.01)."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from conftest import SF_SMALL
import __spark_entry__ as entry_mod
from tidemark.plans.registry import MEASURED, QUERIES

TABLES = ["customer", "part", "events"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MEASURED))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    got = Counter(tuple(_norm(x) for x in r) for r in df.collect())
    cur = con.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    idx = [cols.index(c) for c in df.columns]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want
