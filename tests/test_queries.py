"""Every query with SQL against DuckDB, on the smallest driver tables."""

import os

import duckdb
import pytest

from cosecha import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def key(v):
    return "" if v is None or v != v else f"{v:.6f}" if isinstance(v, int | float) and not isinstance(v, bool) else str(v)[:10] if hasattr(v, "year") else str(v)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_duckdb(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == names
    mine = sorted(tuple(key(r[c]) for c in names) for r in got.collect())
    at = [want.columns.index(c) for c in names]
    assert mine == sorted(tuple(key(r[i]) for i in at) for r in want.fetchall())
