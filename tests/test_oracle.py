"""Every registered query against its DuckDB oracle at sf0.001 (the driver
runs the same comparison at sf0.01; ``tools/check_oracle.py`` does it by hand).
"""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from aerolap.plans.catalog import QUERIES
from tools.check_oracle import _digest, duck
from tests.conftest import SF_SMALL

SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
FLAT_TYPES = {"string", "int", "bigint", "double", "boolean"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only == set()
    assert set(QUERIES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["op_unique_carrier", "route", "num_flights", "min_arr_delay",
                          "max_arr_delay", "avg_arr_delay", "cancel_rate", "months"]
    assert df.count() == 3765


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    # the query surface is flat and engine-neutral: no dates, arrays or structs
    assert {f.dataType.simpleString() for f in sdf.schema.fields} <= FLAT_TYPES
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(SQL[key])
    d_rows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(s_rows) == len(d_rows)
    assert _digest(sdf.columns, s_rows, True) == _digest(rel.columns, d_rows, True)
