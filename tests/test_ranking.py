"""Carrier-vs-airport ranking."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolap.operators import ranking as R
from aerolap.operators.clean import clean
from aerolap.plans.explain import count_nodes, python_nodes, read_schemas
from aerolap.sources.fixtures import load_raw_flights
from tests.conftest import SF_MID, SF_SMALL, make_flights


def _f(origin, carrier, dep=None, arr=None, cancelled=0):
    return {"origin": origin, "op_unique_carrier": carrier, "dep_delay": dep, "arr_delay": arr,
            "cancelled": cancelled}


def test_rank_ties_broken_by_carrier_and_null_first(spark):
    rows = [
        _f("JFK", "UA", dep=10.0), _f("JFK", "AA", dep=10.0),   # V13: tie -> carrier asc
        _f("JFK", "DL", dep=2.0),
        _f("JFK", "B6", dep=None),                              # V11: null mean first
    ]
    got = [(r.op_unique_carrier, r.rank, r.avg_dep_delay)
           for r in R.carrier_ranking(make_flights(spark, rows)).collect()]
    assert got == [("B6", 1, None), ("DL", 2, 2.0), ("AA", 3, 10.0), ("UA", 4, 10.0)]


def test_gap_uses_rounded_carrier_mean_and_unrounded_airport_mean(spark):
    """round(round(carrier mean, 2) - airport mean, 2)."""
    rows = [_f("JFK", "AA", dep=1.0), _f("JFK", "AA", dep=2.0), _f("JFK", "AA", dep=2.0),
            _f("JFK", "DL", dep=0.0)]
    out = {r.op_unique_carrier: r for r in R.carrier_ranking(make_flights(spark, rows)).collect()}
    base = (1.0 + 2.0 + 2.0 + 0.0) / 4
    assert out["AA"].avg_dep_delay == round(5.0 / 3, 2)
    assert out["AA"].dep_delay_diff == round(round(5.0 / 3, 2) - base, 2)
    assert out["DL"].dep_delay_diff == round(0.0 - base, 2)


def test_null_origin_dropped_and_null_flags_left_out(spark):
    """V15 and V14 (cancel rate over non-null flags only)."""
    rows = [_f(None, "AA", dep=1.0), _f("JFK", "AA", dep=1.0, cancelled=1),
            _f("JFK", "AA", dep=1.0, cancelled=None), _f("JFK", "AA", dep=1.0, cancelled=0)]
    out = R.carrier_ranking(make_flights(spark, rows)).collect()
    assert [(r.origin, r.num_flights, r.cancel_rate) for r in out] == [("JFK", 3, 0.5)]


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID])
def test_window_form_equals_join_form(spark, sf_dir):
    f = clean(load_raw_flights(spark, sf_dir))
    a = R.carrier_ranking(f, ordered=False)
    b = R.carrier_ranking_joined(f, ordered=False)
    assert a.count() == 300  # FIXTURES.md §4
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ranks_are_one_to_n(spark):
    f = clean(load_raw_flights(spark, SF_SMALL))
    r = R.carrier_ranking(f, ordered=False)
    per = r.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"),
                                  F.max("rank").alias("hi"), F.count_distinct("rank").alias("d"))
    assert per.filter((F.col("lo") != 1) | (F.col("hi") != F.col("n")) |
                      (F.col("d") != F.col("n"))).count() == 0
    # ranks follow the rounded mean
    w = Window.partitionBy("origin").orderBy("rank")
    bad = r.withColumn("prev", F.lag("avg_dep_delay").over(w)).filter(
        F.col("prev") > F.col("avg_dep_delay"))
    assert bad.count() == 0


def test_airport_baseline(spark):
    f = clean(load_raw_flights(spark, SF_SMALL))
    b = R.airport_baseline(f)
    assert b.count() == 25
    direct = f.groupBy("origin").agg((F.sum("dep_delay") / F.count("dep_delay")).alias("x"))
    j = b.join(direct, "origin").filter(F.abs(F.col("x") - F.col("airport_avg_dep_delay")) > 1e-9)
    assert j.count() == 0


def test_single_scan_plan(spark):
    f = clean(load_raw_flights(spark, SF_SMALL))
    df = R.carrier_ranking(f)
    assert len(read_schemas(df)) == 1
    assert count_nodes(df, "SortMergeJoin") + count_nodes(df, "BroadcastHashJoin") == 0
    assert python_nodes(df) == 0
    joined = R.carrier_ranking_joined(f)
    assert len(read_schemas(joined)) == 2


def test_rank_uses_rounded_mean(spark):
    """Means 1.004 and 1.001 both round to 1.0, so they tie and the
    carrier code decides; the unrounded order would be the reverse."""
    rows = [_f("JFK", "AA", dep=1.004), _f("JFK", "UA", dep=1.001)]
    got = [(r.op_unique_carrier, r.rank, r.avg_dep_delay)
           for r in R.carrier_ranking(make_flights(spark, rows)).collect()]
    assert got == [("AA", 1, 1.0), ("UA", 2, 1.0)]
