"""Column functions on literal edge values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerolap.functions import (
    band_rank,
    cancel_cause,
    delay_band,
    elapsed,
    flight_band,
    hhmm_to_minutes,
    month_name,
    normalise_code,
    route_key,
    timezone_ok,
    wrap_24h,
)


def _one(spark, expr, schema, values):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_hhmm_to_minutes(spark):
    vals = ["0", "59", "100", "830", "2359", "2400", "NA", "", "12x", None, "830.5"]
    got = _one(spark, hhmm_to_minutes("x"), "x string", vals)
    assert got == [0.0, 59.0, 60.0, 510.0, 1439.0, 1440.0, None, None, None, None, 510.5]


def test_hhmm_negative_uses_floor_semantics(spark):
    # floor division and a non-negative remainder: -30 // 100 = -1, -30 % 100 = 70
    assert _one(spark, hhmm_to_minutes("x"), "x double", [-30.0]) == [-60.0 + 70.0]


def test_wrap_24h(spark):
    vals = [0, 719, 720, -720, -721, 1440, 1500, -1500, None]
    got = _one(spark, wrap_24h("x"), "x int", vals)
    assert got == [0, 719, -720, -720, 719, 0, 60, -60, None]


def test_elapsed_crosses_midnight(spark):
    df = spark.createDataFrame(
        [(1430.0, 10.0), (10.0, 1430.0), (100.0, 100.0), (None, 5.0)], "a double, b double"
    )
    got = [r[0] for r in df.select(elapsed("a", "b")).collect()]
    assert got == [20.0, 1420.0, 0.0, None]


def test_timezone_ok(spark):
    df = spark.createDataFrame(
        [(46.0, 45.0), (105.0, 45.0), (45.0, 45.0), (-15.0, 45.0), (None, 45.0), (30.0, None),
         (45.5, 45.0)],
        "e double, a double",
    )
    got = [r[0] for r in df.select(timezone_ok("e", "a")).collect()]
    assert got == [False, True, True, True, False, False, False]


@pytest.mark.parametrize(
    "delay,band",
    [(None, None), (-5.0, None), (0.0, None), (0.5, "low"), (14.0, "low"), (14.9, "low"),
     (15.0, "medium"), (60.0, "medium"), (60.5, "high"), (61.0, "high")],
)
def test_delay_band_edges(spark, delay, band):
    assert _one(spark, delay_band("x"), "x double", [delay]) == [band]


def test_flight_band(spark):
    df = spark.createDataFrame(
        [(1, None), (1, 30.0), (0, 30.0), (0, 0.0), (None, 30.0), (0, None)],
        "c int, d double",
    )
    got = [r[0] for r in df.select(flight_band("c", "d")).collect()]
    assert got == ["cancelled", "cancelled", "medium", None, None, None]


def test_band_rank(spark):
    got = _one(spark, band_rank("x"), "x string", ["low", "medium", "high", "cancelled", None])
    assert got == [1, 2, 3, 4, 4]


def test_cancel_cause(spark):
    got = _one(spark, cancel_cause("x"), "x string", ["A", "B", "C", "D", "E", None])
    assert got == ["carrier", "weather", "nas", "security", None, None]


def test_month_name(spark):
    got = _one(spark, month_name("x"), "x int", [1, 6, 12, 13, None])
    assert got == ["January", "June", "December", "13", None]


def test_route_key_skips_null_side(spark):
    df = spark.createDataFrame([("JFK", "LAX"), (None, "LAX"), ("JFK", None)], "o string, d string")
    got = [r[0] for r in df.select(route_key("o", "d")).collect()]
    assert got == ["JFK-LAX", "LAX", "JFK"]


def test_normalise_code(spark):
    got = _one(spark, normalise_code("x"), "x string", [" dl ", "Aa", None])
    assert got == ["DL", "AA", None]


def test_functions_stay_in_codegen(spark):
    df = spark.createDataFrame([("830", 1, 20.0)], "t string, c int, d double")
    plan = df.select(hhmm_to_minutes("t"), flight_band("c", "d"), wrap_24h(F.col("d")))._jdf \
        .queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
