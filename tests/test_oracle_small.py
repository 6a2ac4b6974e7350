"""Every registered query against its SQL oracle on the smallest tables
(the same comparison the correctness gate makes at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import _rows
from umpire.session import TABLES

from conftest import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, got) == _rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLE)))
def test_query_without_oracle_runs(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() >= 0
