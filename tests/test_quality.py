"""Data-quality and time-consistency checks (Q1-Q21)."""

from __future__ import annotations

import math

from aerolap.operators import quality as Q
from aerolap.operators import timechecks as TC
from aerolap.plans.explain import count_nodes
from aerolap.schema import RAW_COLUMNS
from aerolap.sources.fixtures import KEY_COLUMNS, load_raw_flights
from tests.conftest import SF_SMALL, make_raw

# A real row shape: flagged because wheels 800 -> 846 is 46 minutes while the
# stored air time is 45 (the first bad row of the reference's check output).
BAD_ROW = {
    "origin": "GEG", "dest": "SEA", "crs_dep_time": 655, "dep_time": 657.0, "dep_delay": 2.0,
    "taxi_out": 63.0, "wheels_off": 800.0, "wheels_on": 846.0, "taxi_in": 10.0,
    "crs_arr_time": 830, "arr_time": 856.0, "arr_delay": 26.0, "cancelled": 0.0,
    "diverted": 0.0, "actual_elapsed_time": 118.0, "air_time": 45.0,
}


def test_validation_facts_sf0001(spark):
    """FIXTURES.md §4: entering rows and errors per check at sf0.001."""
    raw = load_raw_flights(spark, SF_SMALL)
    assert TC.flown(raw).count() == 5849
    rep = {r.check: r.error_count for r in TC.validation_report(raw).collect()}
    assert rep == {"dep_delay": 0, "arr_delay": 0, "taxi_out": 49, "taxi_in": 0, "air_time": 52,
                   "actual_elapsed_time": 0, "components_sum": 101}
    assert TC.bad_rows(raw).count() == 101
    assert [r.position for r in TC.validation_report(raw).collect()] == list(range(1, 8))


def test_real_row_shape(spark):
    raw = make_raw(spark, [BAD_ROW])
    t = TC.with_time_checks(raw).first()
    assert t.expected_air_time == 46.0 and t.err_air_time              # 800 -> 846 vs 45
    assert t.expected_actual_elapsed_time == 119.0 and t.err_actual_elapsed_time  # 657 -> 856 vs 118
    assert t.expected_taxi_out == 63.0 and not t.err_taxi_out          # 657 -> 800
    assert t.expected_taxi_in == 10.0 and not t.err_taxi_in
    assert not t.err_dep_delay and not t.err_arr_delay
    assert not t.err_components_sum  # 63 + 45 + 10 = 118
    assert t.any_error


def test_time_checks_null_fails_and_midnight(spark):
    rows = [
        # crosses midnight: 2350 -> 0010 is 20 minutes
        {"dep_time": 2350.0, "wheels_off": 10.0, "taxi_out": 20.0, "wheels_on": 100.0,
         "air_time": 50.0, "arr_time": 110.0, "taxi_in": 10.0, "actual_elapsed_time": 80.0,
         "crs_dep_time": 2340, "dep_delay": 10.0, "crs_arr_time": 100, "arr_delay": 10.0,
         "cancelled": 0.0, "diverted": 0.0},
        # a missing taxi_out fails both its check and the component sum
        {"dep_time": 1000.0, "wheels_off": 1010.0, "taxi_out": None, "wheels_on": 1100.0,
         "air_time": 50.0, "arr_time": 1110.0, "taxi_in": 10.0, "actual_elapsed_time": 70.0,
         "crs_dep_time": 1000, "dep_delay": 0.0, "crs_arr_time": 1110, "arr_delay": 0.0,
         "cancelled": 0.0, "diverted": 0.0},
        # cancelled / null flag rows do not enter
        {"cancelled": 1.0, "diverted": 0.0}, {"cancelled": None, "diverted": 0.0},
    ]
    out = TC.with_time_checks(make_raw(spark, rows)).collect()
    assert len(out) == 2
    a, b = out
    assert (a.expected_taxi_out, a.expected_air_time, a.expected_taxi_in, a.expected_actual_elapsed_time) == \
        (20.0, 50.0, 10.0, 80.0)
    assert not a.any_error
    assert b.err_taxi_out and b.err_components_sum and not b.err_air_time


def test_error_examples_limit_and_order(spark):
    raw = load_raw_flights(spark, SF_SMALL)
    ex = TC.error_examples(raw, keys=KEY_COLUMNS, n=3)
    assert TC.error_examples(raw, n=2000).count() > 40  # the flight's own keys, any n
    rows = ex.collect()
    by = {}
    for r in rows:
        by.setdefault(r.field, []).append(r)
    assert set(by) == {"taxi_out", "air_time"}
    for field, rs in by.items():
        assert [r.example_rank for r in sorted(rs, key=lambda r: r.example_rank)] == [1, 2, 3]
        keys = [tuple(getattr(r, k) for k in KEY_COLUMNS)
                for r in sorted(rs, key=lambda r: r.example_rank)]
        assert keys == sorted(keys)
        for r in rs:
            if r.stored is None:
                assert r.diff is None
            else:
                assert r.diff == r.expected - r.stored
    # a group limit runs before the shuffle, so each task ships at most n per bucket
    assert count_nodes(ex, "WindowGroupLimit") >= 1
    for r in rows:
        assert r.field_errors >= 3
        if r.field == "air_time":
            assert r.start_clock is not None and r.end_clock is not None


def test_nan_is_missing_in_the_component_check(spark):
    nan = float("nan")
    rows = TC.with_time_checks(make_raw(spark, [
        {**BAD_ROW, "taxi_out": nan, "actual_elapsed_time": nan}])).collect()
    assert rows[0].err_components_sum


def test_null_report(spark):
    raw = make_raw(spark, [{"dep_delay": float("nan"), "origin": "A"}, {"origin": None},
                           {"dep_delay": 1.0, "origin": "B"}])
    rep = Q.null_report(raw.select("origin", "dep_delay", "year")).collect()
    got = [(r.column, r.null_count, r.null_percentage) for r in rep]
    # NaN counts as missing; sorted by count desc then name
    assert got == [("year", 3, 100.0), ("dep_delay", 2, 66.6667), ("origin", 1, 33.3333)]


def test_null_report_one_pass(spark):
    raw = load_raw_flights(spark, SF_SMALL).select(*RAW_COLUMNS)
    rep = Q.null_report(raw)
    assert rep.count() == 35
    # one aggregation for all 35 columns
    assert count_nodes(rep, "HashAggregate") == 2


def test_flag_profile_and_distribution(spark):
    raw = make_raw(spark, [{"cancelled": 1.0}, {"cancelled": 0.0}, {"cancelled": 0.0},
                           {"cancelled": None}])
    p = Q.flag_profile(raw, "cancelled").first()
    assert tuple(p) == (4, 1, 2, 1)
    d = {r.cancelled: r.num_rows for r in Q.value_distribution(raw, "cancelled").collect()}
    assert d == {1.0: 1, 0.0: 2, None: 1}


def test_describe_subset(spark):
    raw = make_raw(spark, [{"cancelled": 1.0, "dep_delay": 1.0}, {"cancelled": 1.0, "dep_delay": 3.0},
                           {"cancelled": 0.0, "dep_delay": 100.0}])
    d = {(r.column, r.metric): r.value for r in
         Q.describe_subset(raw, "cancelled", ["dep_delay", "arr_delay"]).collect()}
    assert d[("dep_delay", "count")] == 2.0
    assert d[("dep_delay", "mean")] == 2.0
    assert abs(d[("dep_delay", "stddev")] - math.sqrt(2.0)) < 1e-12
    assert (d[("dep_delay", "min")], d[("dep_delay", "max")]) == (1.0, 3.0)
    assert d[("arr_delay", "count")] == 0.0 and d[("arr_delay", "mean")] is None


def test_bad_months_and_distribution(spark):
    raw = make_raw(spark, [{"month": 0}, {"month": 13}, {"month": 12}, {"month": None}])
    assert sorted(r.month for r in Q.bad_months(raw).collect()) == [0, 13]
    d = [(r.month, r.num_rows) for r in Q.month_distribution(raw).collect()]
    assert d == [(None, 1), (0, 1), (12, 1), (13, 1)]


def test_split_counts(spark):
    raw = make_raw(spark, [{"cancelled": 1.0, "diverted": 0.0}, {"cancelled": 0.0, "diverted": 1.0},
                           {"cancelled": 0.0, "diverted": 0.0}, {"cancelled": None, "diverted": 0.0}])
    assert tuple(Q.split_counts(raw).first()) == (4, 2, 1)


def test_sample_rows_is_bounded_top_n(spark):
    raw = load_raw_flights(spark, SF_SMALL)
    s = Q.sample_rows(raw, "cancelled", KEY_COLUMNS, ["dep_delay"], n=10)
    rows = s.collect()
    assert len(rows) == 10
    assert [tuple(r)[:4] for r in rows] == sorted(tuple(r)[:4] for r in rows)
    assert count_nodes(s, "TakeOrderedAndProject") == 1


def test_schema_frame(spark):
    raw = make_raw(spark, [{}])
    rows = Q.schema_frame(raw).collect()
    assert len(rows) == 35 and rows[0].column == "year" and rows[0].type == "int"


def test_row_count(spark):
    assert Q.row_count(load_raw_flights(spark, SF_SMALL)).first().row_count == 6000
    assert Q.row_count(make_raw(spark, [{}, {}])).first()[0] == 2
