"""Cleaning (C1-C5) on literal rows, including dirty text and null flags."""

from __future__ import annotations

from aerolap.operators.clean import cast_types, clean, normalise_codes, void_delays
from aerolap.schema import CLEAN_SCHEMA, RAW_COLUMNS
from tests.conftest import make_raw


def test_clean_keeps_columns_and_order(spark):
    raw = make_raw(spark, [{"origin": " jfk "}])
    out = clean(raw)
    assert out.columns == RAW_COLUMNS
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in CLEAN_SCHEMA.fields]


def test_normalise_codes(spark):
    raw = make_raw(spark, [{"op_unique_carrier": " dl ", "origin": "geg", "dest": " Sea"}])
    r = normalise_codes(raw).first()
    assert (r.op_unique_carrier, r.origin, r.dest) == ("DL", "GEG", "SEA")


def test_cast_types_from_text_gives_null_on_bad_values(spark):
    df = spark.createDataFrame(
        [("1", "1.0", "0", "12.5", "NA"), ("x", "", "1", "bad", "3")],
        "month string, cancelled string, diverted string, arr_delay string, dep_delay string",
    )
    rows = cast_types(df).collect()
    assert tuple(rows[0]) == (1, 1, 0, 12.5, None)
    assert tuple(rows[1]) == (None, None, 1, None, 3.0)


def test_void_delays_rules(spark):
    raw = make_raw(
        spark,
        [
            # cancelled: both delays go
            {"cancelled": 1.0, "diverted": 0.0, "dep_delay": 5.0, "arr_delay": 7.0},
            # diverted: only the arrival delay goes
            {"cancelled": 0.0, "diverted": 1.0, "dep_delay": 5.0, "arr_delay": 7.0},
            # flown
            {"cancelled": 0.0, "diverted": 0.0, "dep_delay": 5.0, "arr_delay": 7.0},
            # null flags keep the values
            {"cancelled": None, "diverted": None, "dep_delay": 5.0, "arr_delay": 7.0},
            # null cancelled, diverted 1: arrival goes
            {"cancelled": None, "diverted": 1.0, "dep_delay": 5.0, "arr_delay": 7.0},
        ],
    )
    got = [(r.dep_delay, r.arr_delay) for r in clean(raw).collect()]
    assert got == [(None, None), (5.0, None), (5.0, 7.0), (5.0, 7.0), (5.0, None)]


def test_void_delays_is_a_projection(spark):
    raw = make_raw(spark, [{"cancelled": 1.0, "dep_delay": 1.0}])
    plan = void_delays(cast_types(raw))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_fixture_cleaning_facts(spark):
    """FIXTURES.md §4 at sf0.001: cancelled rows lose the departure delay."""
    from pyspark.sql import functions as F

    from aerolap.sources.fixtures import load_raw_flights

    raw = load_raw_flights(spark, "/root/testdata/sf0.001")
    r = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("cancelled") == 1).alias("canc"),
        F.count_if(F.col("diverted") == 1).alias("div"),
        F.count_if((F.col("cancelled") == 1) & F.col("dep_delay").isNotNull()).alias("canc_dep"),
        F.count("cancellation_code").alias("codes"),
    ).first()
    assert tuple(r) == (6000, 108, 43, 17, 72)
    c = clean(raw).agg(
        F.count_if((F.col("cancelled") == 1) & F.col("dep_delay").isNotNull()).alias("a"),
        F.count_if((F.col("diverted") == 1) & F.col("arr_delay").isNotNull()).alias("b"),
        F.count_distinct("origin").alias("origins"),
        F.count_distinct("op_unique_carrier").alias("carriers"),
    ).first()
    assert tuple(c) == (0, 0, 25, 12)
