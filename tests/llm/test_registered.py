"""Registered queries of this package against their SQL, and their columns."""
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.llm.queries import ORACLE, QUERIES

from .conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    rows = Counter(tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall())
    assert Counter(map(tuple, df.collect())) == rows


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES if q.startswith("op")}
    assert "pipeline" in entry.queries() and set(ORACLE) <= set(QUERIES)
