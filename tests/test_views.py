"""Inspection views."""

from __future__ import annotations

from aerolap.operators import bands as B
from aerolap.operators import ranking as R
from aerolap.operators import views as V
from aerolap.operators.clean import clean
from aerolap.operators.routes import route_stats
from aerolap.plans.explain import count_nodes
from aerolap.sources.fixtures import load_raw_flights
from tests.conftest import SF_SMALL


def _f(spark):
    return clean(load_raw_flights(spark, SF_SMALL))


def test_top_routes_default_first_three_carriers(spark):
    stats = route_stats(_f(spark), ordered=False)
    v = V.top_routes(stats, n=10)
    rows = v.collect()
    carriers = sorted({r.op_unique_carrier for r in rows})
    first3 = [r[0] for r in stats.select("op_unique_carrier").distinct()
              .orderBy("op_unique_carrier").limit(3).collect()]
    assert carriers == first3
    for c in carriers:
        rs = [r for r in rows if r.op_unique_carrier == c]
        assert [r.position for r in rs] == list(range(1, 11))
        flights = [r.num_flights for r in rs]
        assert flights == sorted(flights, reverse=True)
    # the key side of the semi join is bounded by n and broadcast
    assert count_nodes(v, "BroadcastExchange") >= 1


def test_top_routes_explicit_carriers(spark):
    stats = route_stats(_f(spark), ordered=False)
    rows = V.top_routes(stats, carriers=["C5"], n=3).collect()
    assert [(r.op_unique_carrier, r.position) for r in rows] == [("C5", 1), ("C5", 2), ("C5", 3)]


def test_route_counts_sum(spark):
    stats = route_stats(_f(spark), ordered=False)
    counts = V.route_counts(stats).collect()
    assert sum(r.num_routes for r in counts) == stats.count() and len(counts) == 12


def test_band_view(spark):
    rep = B.band_report(_f(spark), ordered=False)
    v = V.band_view(rep).collect()
    airports = sorted({r.origin for r in v})
    assert len(airports) == 3
    for a in airports:
        months = sorted({r.month for r in v if r.origin == a})
        assert len(months) == 3 and months == sorted(months)
    # null cause lists become empty lists
    assert all(r.top_causes is not None for r in v)
    assert any(len(r.top_causes) == 0 for r in v)
    assert v[0].month_name in {"January", "February", "March"}


def test_ranking_view_and_summary(spark):
    rk = R.carrier_ranking(_f(spark), ordered=False)
    v = V.ranking_view(rk, n=5).collect()
    assert len({r.origin for r in v}) == 3 and all(r.rank <= 5 for r in v)
    s = V.ranking_summary(rk).first()
    assert (s.total_airports, s.total_rows, s.rows_per_airport) == (25, 300, 12.0)
    only = V.ranking_view(rk, airports=["A7"]).collect()
    assert {r.origin for r in only} == {"A7"} and len(only) == 10


def test_distinct_and_profile(spark):
    f = _f(spark)
    stats = route_stats(f, ordered=False)
    d = V.distinct_summary(stats).first()
    assert (d.num_carriers, d.num_rows) == (12, 3765)
    p = {r.result: (r.row_count, r.column_count) for r in V.profile({
        "route_stats": stats,
        "band_report": B.band_report(f, ordered=False),
        "carrier_ranking": R.carrier_ranking(f, ordered=False),
    }).collect()}
    assert p == {"route_stats": (3765, 8), "band_report": (879, 7), "carrier_ranking": (300, 8)}
