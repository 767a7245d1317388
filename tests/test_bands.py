"""Delay-band report (A2): corner cases of §2.10 and single-pass = multi-step."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerolap.operators import bands as B
from aerolap.operators.clean import clean
from aerolap.plans.explain import count_nodes, pushed_filters, python_nodes, read_schemas
from aerolap.sources.fixtures import load_raw_flights
from tests.conftest import SF_MID, SF_SMALL, make_flights


def _flight(origin="JFK", month=1, dep=None, arr=None, cancelled=0, code=None, **causes):
    row = {"origin": origin, "month": month, "dep_delay": dep, "arr_delay": arr,
           "cancelled": cancelled, "cancellation_code": code}
    for c in ["carrier_delay", "weather_delay", "nas_delay", "security_delay",
              "late_aircraft_delay"]:
        row[c] = causes.get(c, 0)
    return row


def _report(spark, rows, k=3):
    df = B.band_report(make_flights(spark, rows), k=k)
    return {(r.origin, r.month, r.band): r for r in df.collect()}


def _causes(r):
    return None if r.top_causes is None else [(c.cause, c.cause_count) for c in r.top_causes]


def test_band_edges_and_exclusions(spark):
    rows = [
        _flight(dep=0.0), _flight(dep=-3.0), _flight(dep=None),     # not in the report
        _flight(dep=1.0, arr=2.0), _flight(dep=14.0, arr=4.0),      # low
        _flight(dep=15.0, arr=0.0), _flight(dep=60.0, arr=0.0),     # medium
        _flight(dep=61.0, arr=70.0),                                # high
    ]
    rep = _report(spark, rows)
    assert set(rep) == {("JFK", 1, "low"), ("JFK", 1, "medium"), ("JFK", 1, "high")}
    low = rep[("JFK", 1, "low")]
    assert (low.num_flights, low.avg_dep_delay, low.avg_arr_delay) == (2, 7.5, 3.0)
    # V7: a mean of exactly 0.0 stays 0.0
    assert rep[("JFK", 1, "medium")].avg_arr_delay == 0.0


def test_null_cancelled_left_out(spark):
    """V5: a null flag is neither flown nor cancelled."""
    rep = _report(spark, [_flight(dep=20.0, cancelled=None), _flight(dep=20.0)])
    assert rep[("JFK", 1, "medium")].num_flights == 1


def test_cancelled_band_means_null_and_code_causes(spark):
    """V8 and the cancellation vocabulary (carrier, not carrier_delay)."""
    rows = [
        _flight(cancelled=1, dep=5.0, arr=5.0, code="A", carrier_delay=30),
        _flight(cancelled=1, code="A"),
        _flight(cancelled=1, code="B"),
        _flight(cancelled=1, code="Z"),
        _flight(cancelled=1, code=None),
    ]
    r = _report(spark, rows)[("JFK", 1, "cancelled")]
    assert r.num_flights == 5
    assert r.avg_dep_delay is None and r.avg_arr_delay is None
    assert _causes(r) == [("carrier", 2), ("weather", 1)]


def test_top_causes_order_ties_and_limit(spark):
    rows = [
        _flight(dep=20.0, nas_delay=5, weather_delay=5, carrier_delay=5),
        _flight(dep=20.0, nas_delay=5, weather_delay=5, late_aircraft_delay=5),
        _flight(dep=20.0, security_delay=5),
    ]
    r = _report(spark, rows)[("JFK", 1, "medium")]
    # count desc, then cause asc; at most three
    assert _causes(r) == [("nas_delay", 2), ("weather_delay", 2), ("carrier_delay", 1)]
    r1 = _report(spark, rows, k=1)[("JFK", 1, "medium")]
    assert _causes(r1) == [("nas_delay", 2)]


def test_group_without_causes_is_null(spark):
    """V6: no cause -> null list (not an empty one)."""
    r = _report(spark, [_flight(dep=5.0)])[("JFK", 1, "low")]
    assert r.top_causes is None


def test_null_keys_keep_row_but_lose_causes(spark):
    """A null origin or month has statistics but no causes."""
    rows = [_flight(origin=None, dep=20.0, nas_delay=3), _flight(month=None, dep=20.0, nas_delay=3)]
    rep = _report(spark, rows)
    assert rep[(None, 1, "medium")].num_flights == 1
    assert rep[(None, 1, "medium")].top_causes is None
    assert rep[("JFK", None, "medium")].top_causes is None


def test_report_order(spark):
    rows = [_flight(origin="B", dep=70.0), _flight(origin="A", cancelled=1),
            _flight(origin="A", dep=70.0), _flight(origin="A", dep=5.0), _flight(origin="A", dep=30.0),
            _flight(origin="A", month=2, dep=5.0)]
    got = [(r.origin, r.month, r.band) for r in B.band_report(make_flights(spark, rows)).collect()]
    assert got == [("A", 1, "low"), ("A", 1, "medium"), ("A", 1, "high"), ("A", 1, "cancelled"),
                   ("A", 2, "low"), ("B", 1, "high")]


@pytest.mark.parametrize("sf_dir,groups,null_lists", [(SF_SMALL, 879, 234), (SF_MID, 1194, 315)])
def test_single_pass_equals_multi_step(spark, sf_dir, groups, null_lists):
    f = clean(load_raw_flights(spark, sf_dir))
    one = B.band_report(f, ordered=False)
    many = B.band_report_joined(f, ordered=False)
    assert one.count() == groups  # FIXTURES.md §4
    assert one.filter(F.col("top_causes").isNull()).count() == null_lists
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_band_counts_sum_to_delayed_rows(spark):
    f = clean(load_raw_flights(spark, SF_SMALL))
    rep = B.band_report(f, ordered=False)
    flown = rep.filter(F.col("band") != "cancelled").agg(F.sum("num_flights")).first()[0]
    delayed = f.filter((F.col("cancelled") == 0) & (F.col("dep_delay") > 0)).count()
    assert flown == delayed
    canc = rep.filter(F.col("band") == "cancelled").agg(F.sum("num_flights")).first()[0]
    assert canc == f.filter(F.col("cancelled") == 1).count()


def test_multistep_parts_agree(spark):
    f = clean(load_raw_flights(spark, SF_SMALL))
    counts = B.cause_counts(f)
    total = counts.agg(F.sum("cause_count")).first()[0]
    assert total == B.union_causes(f).count()
    assert B.union_causes(f).count() == B.delay_causes(f).count() + B.cancel_causes(f).count()


def test_single_pass_plan(spark):
    """One scan of 11 columns, filters pushed, one aggregation, no Python."""
    f = clean(load_raw_flights(spark, SF_SMALL))
    df = B.band_report(f)
    scans = read_schemas(df)
    assert len(scans) == 1
    assert set(scans[0]) == {"origin", "month", "dep_delay", "arr_delay", "cancelled", "diverted",
                             "cancellation_code", "carrier_delay", "weather_delay", "nas_delay",
                             "security_delay", "late_aircraft_delay"}
    assert count_nodes(df, "HashAggregate") == 2  # partial + final, nothing else
    assert python_nodes(df) == 0
    many = B.band_report_joined(f)
    assert len(read_schemas(many)) > len(scans)


def test_report_filter_reaches_parquet(spark):
    """On the written cleaned table the band filter is pushed into the scan."""
    from aerolap.session import scratch_path
    from aerolap.sources import read_flights, write_parquet

    path = write_parquet(clean(load_raw_flights(spark, SF_SMALL)), scratch_path(spark, "t_bands"))
    df = B.band_report(read_flights(spark, path))
    pushed = pushed_filters(df)
    assert len(pushed) == 1
    assert "EqualTo(cancelled,1)" in pushed[0] and "GreaterThan(dep_delay" in pushed[0]
    assert len(read_schemas(df)[0]) == 11
