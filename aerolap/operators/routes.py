"""Route statistics (A1) and origin-airport statistics.

Per carrier and route: flights, min / max / mean arrival delay, cancel rate
and the sorted set of months served.

Plan: the months of a group are bits of a long, so they fold in the same
codegen'd hash aggregate as the other statistics, with a map-side partial
step; a hot route or hub airport collapses to one row per task before any
shuffle, and rows per (carrier, route, month) never exist. A word of
:data:`WORD` bits holds months 0 to 62; a month outside has a word of its own,
numbered by the quotient, as a further key, so any number is exact and clean data
have one word per group. The second aggregation sees one row per group and
word: it joins the words and decodes their bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolap.functions import ratio, route_key

CARRIER = "op_unique_carrier"


#: Months per word of the bit set (bit 63 would be the sign).
WORD = 63


def _word() -> Column:
    return F.floor(F.col("month") / WORD).alias("_word")


def _bits() -> Column:
    """The months of a group and word, as bits."""
    return F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(month, {WORD}) AS INT))")).alias("_bits")


def _months() -> Column:
    """The sorted distinct months of a group, from its words."""
    words = F.array_sort(F.collect_list(F.when(F.col("_bits").isNotNull(), F.struct("_word", "_bits"))))
    held = F.sequence(F.lit(0), F.lit(WORD - 1))
    return F.flatten(F.transform(words, lambda w: F.transform(
        F.filter(held, lambda i: F.bit_get(w["_bits"], i) == 1),
        lambda i: (w["_word"] * WORD + i).cast("int"))))


def _states(flights: DataFrame, place_col: str, place_expr: Column,
            extra: Sequence[str] = ()) -> DataFrame:
    """Mergeable rows: one per carrier, place and word of months (and ``extra`` keys)."""
    f = flights.select(
        *extra, F.col(CARRIER), place_expr.alias(place_col), "month", "arr_delay", "cancelled"
    )
    return f.groupBy(*extra, CARRIER, place_col, _word()).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("arr_delay").alias("_min"),
        F.max("arr_delay").alias("_max"),
        F.sum("arr_delay").alias("_sum"),
        F.count("arr_delay").alias("_cnt"),
        F.sum("cancelled").alias("_canc"),
        _bits(),
    )


def _finish(states: DataFrame, place_col: str) -> DataFrame:
    """The statistics, from at most one state per carrier, place and word."""
    return states.groupBy(CARRIER, place_col).agg(
        F.sum("_n").alias("num_flights"),
        F.min("_min").alias("min_arr_delay"),
        F.max("_max").alias("max_arr_delay"),
        F.round(ratio(F.sum("_sum"), F.sum("_cnt")), 2).alias("avg_arr_delay"),
        F.round(ratio(F.sum("_canc"), F.sum("_n")), 4).alias("cancel_rate"),
        _months().alias("months"),
    )


def _place_stats(flights: DataFrame, place_col: str, place_expr: Column) -> DataFrame:
    return _finish(_states(flights, place_col, place_expr), place_col)


def route_states(flights: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """A1 as mergeable states, per value of the ``extra`` columns."""
    return _states(flights, "route", route_key("origin", "dest"), extra)


def route_stats_of(states: DataFrame) -> DataFrame:
    """A1 from any number of states, in any order (see ``operators.states``)."""
    merged = states.groupBy(CARRIER, "route", "_word").agg(
        *[F.sum(c).alias(c) for c in ("_n", "_sum", "_cnt", "_canc")],
        F.min("_min").alias("_min"), F.max("_max").alias("_max"), F.bit_or("_bits").alias("_bits"))
    return _finish(merged, "route").orderBy(CARRIER, "route")


def route_stats(flights: DataFrame, ordered: bool = True) -> DataFrame:
    """A1 on the cleaned table.

    Semantics: the route is ``concat_ws('-', origin, dest)`` (a null side is
    skipped); the mean skips null delays; the cancel rate is
    ``sum(cancelled) / count(*)`` (a null flag adds 0 but stays in the
    divisor; all-null gives null); a null month is not in ``months``.
    """
    out = _place_stats(flights, "route", route_key("origin", "dest"))
    return out.orderBy(CARRIER, "route") if ordered else out


def origin_stats(flights: DataFrame, ordered: bool = True) -> DataFrame:
    """The same metrics per carrier and departure airport."""
    out = _place_stats(flights, "origin", F.col("origin"))
    return out.orderBy(CARRIER, "origin") if ordered else out


def route_months(flights: DataFrame) -> DataFrame:
    """G4 on its own: sorted distinct months served per carrier and route."""
    per_word = flights.select(
        CARRIER, route_key("origin", "dest").alias("route"), "month"
    ).groupBy(CARRIER, "route", _word()).agg(_bits())
    return per_word.groupBy(CARRIER, "route").agg(_months().alias("months"))
