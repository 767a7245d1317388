"""Queries with SQL against that SQL, and the shape of all of them."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from aerolap.llm.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracle import _digest, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_equal_to_sql(spark, con, key):
    df, rel = QUERIES[key](spark, SF_SMALL), con.sql(ORACLE_SQL[key])
    assert sorted(df.columns) == sorted(rel.columns)
    rows, want = [tuple(r) for r in df.collect()], rel.fetchall()
    assert len(rows) == len(want)
    assert _digest(df.columns, rows, False) == _digest(rel.columns, want, False)


def test_all_are_registered():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(E.queries())
    assert set(ORACLE_SQL) <= set(E.oracle_sql())
