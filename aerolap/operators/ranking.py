"""Carrier-vs-airport ranking (A3), airport baseline.

Per departure airport and carrier: flights, mean departure and arrival
delay, cancel rate, the gap of the carrier's (rounded) mean departure delay
to the airport's mean over all its flights, and the carrier's rank in the
airport by rounded mean departure delay (ascending, nulls first, ties
broken by carrier code).

``carrier_ranking`` is one scan and one partial/final aggregation by
(origin, carrier) that keeps the unrounded sum and count of the departure
delay; the airport mean is a window sum over those few rows per airport,
so no second scan, no second aggregation of the raw rows and no join.
A hub airport is not a skew problem: it is one row per carrier after the
map-side partial aggregate. ``carrier_ranking_joined`` is the
join-with-baseline form (J2), kept as an operator of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolap.functions import ratio
from aerolap.sources.files import materialise

CARRIER = "op_unique_carrier"


def _rank_window():
    return Window.partitionBy("origin").orderBy(F.col("avg_dep_delay").asc_nulls_first(),
                                                F.col(CARRIER).asc())


def _sums(flights: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Flights, delay sums and counts, and cancellations per (airport, carrier)."""
    return flights.groupBy(*extra, "origin", CARRIER).agg(
        F.count(F.lit(1)).alias("num_flights"),
        *[f(c).alias(f"{c}_{n}") for c in ("dep_delay", "arr_delay", "cancelled")
          for n, f in (("sum", F.sum), ("n", F.count))])


def airport_baseline(flights: DataFrame) -> DataFrame:
    """Unrounded mean departure delay of all flights of each airport."""
    return flights.groupBy("origin").agg(
        ratio(F.sum("dep_delay"), F.count("dep_delay")).alias("airport_avg_dep_delay"))


def ranking_states(flights: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """A3 as mergeable states, per value of the ``extra`` columns."""
    f = flights.select(*extra, "origin", CARRIER, "dep_delay", "arr_delay", "cancelled")
    return _sums(f.filter(F.col("origin").isNotNull()), extra)


def carrier_ranking_of(states: DataFrame) -> DataFrame:
    """A3 from any number of states, in any order (see ``operators.states``)."""
    sums = [c for c in states.columns if c == "num_flights" or c.endswith(("_sum", "_n"))]
    merged = states.groupBy("origin", CARRIER).agg(*[F.sum(c).alias(c) for c in sums])
    return _ranked(merged).orderBy("origin", "rank")


def carrier_ranking(flights: DataFrame, ordered: bool = True) -> DataFrame:
    """A3, single pass: aggregate by (origin, carrier), window over origin.

    Null origins are left out (the reference's inner join drops them).
    """
    out = _ranked(ranking_states(flights))
    return out.orderBy("origin", "rank") if ordered else out


def _ranked(per: DataFrame) -> DataFrame:
    """The ranking, from one state per (airport, carrier).

    The airport sums use the rank's partition and order with a whole-partition
    frame, so both windows share one sort and one Window operator.
    """
    ranked = _rank_window()
    airport = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = ratio(F.sum("dep_delay_sum").over(airport), F.sum("dep_delay_n").over(airport))
    return (
        per.select(
            "origin",
            CARRIER,
            "num_flights",
            F.round(ratio("dep_delay_sum", "dep_delay_n"), 2).alias("avg_dep_delay"),
            F.round(ratio("arr_delay_sum", "arr_delay_n"), 2).alias("avg_arr_delay"),
            F.round(ratio("cancelled_sum", "cancelled_n"), 4).alias("cancel_rate"),
            "dep_delay_sum",
            "dep_delay_n",
        )
        .select("*", base.alias("_base"), F.row_number().over(ranked).alias("rank"))
        .select(
            "origin", CARRIER, "num_flights", "avg_dep_delay", "avg_arr_delay", "cancel_rate",
            F.round(F.col("avg_dep_delay") - F.col("_base"), 2).alias("dep_delay_diff"),
            "rank",
        )
    )


def carrier_ranking_joined(flights: DataFrame, ordered: bool = True) -> DataFrame:
    """A3 in join form (J2): carriers joined to the mean of their airport.

    The sums per (airport, carrier) are written once; the airport's mean adds
    up those few rows, so the flights are scanned once. An airport without a
    name has no partner. No broadcast hint: AQE decides from measured sizes.
    """
    per = materialise(_sums(flights.select("origin", CARRIER, "dep_delay", "arr_delay",
                                           "cancelled")), "carrier_sums")
    airports = per.groupBy("origin").agg(
        ratio(F.sum("dep_delay_sum"), F.sum("dep_delay_n")).alias("_mean"))
    mean = {c: ratio(f"{c}_sum", f"{c}_n") for c in ("dep_delay", "arr_delay", "cancelled")}
    out = per.join(airports, "origin").select(
        "origin", CARRIER, "num_flights",
        F.round(mean["dep_delay"], 2).alias("avg_dep_delay"),
        F.round(mean["arr_delay"], 2).alias("avg_arr_delay"),
        F.round(mean["cancelled"], 4).alias("cancel_rate"), "_mean",
    ).select(
        "origin", CARRIER, "num_flights", "avg_dep_delay", "avg_arr_delay", "cancel_rate",
        F.round(F.col("avg_dep_delay") - F.col("_mean"), 2).alias("dep_delay_diff"),
        F.row_number().over(_rank_window()).alias("rank"))
    return out.orderBy("origin", "rank") if ordered else out
