from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from aerolap.schema import RAW_SCHEMA  # noqa: E402
from aerolap.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("aerolap-tests", cpus="*", shuffle_partitions=8)
    yield s
    s.stop()


def make_raw(spark, rows: list[dict]):
    """Raw-schema DataFrame from partial dicts (missing columns are null)."""
    names = RAW_SCHEMA.fieldNames()
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, RAW_SCHEMA)


def make_flights(spark, rows: list[dict]):
    """Cleaned-schema DataFrame from partial dicts."""
    from aerolap.schema import CLEAN_SCHEMA

    names = CLEAN_SCHEMA.fieldNames()
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, CLEAN_SCHEMA)
