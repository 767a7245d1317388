"""Delay-band report (A2) and its parts (A2a-A2e, J1, W1, U1).

Per departure airport, month and band (low / medium / high for flown
flights with a positive departure delay, ``cancelled`` for cancelled ones):
flights, mean departure and arrival delay (null for cancelled), and the
three most frequent causes (count desc, cause asc; null when none).

``band_report`` computes all of it in one scan and one aggregation: the
band is a column, and the nine possible causes (five delay columns, four
cancellation codes) are ``count_if`` counters of the same aggregate, which
runs map-side before the shuffle. The cause list is then built per group
from those counters with array functions. The parts of the report are
operators of their own over the same banded flights and the same aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolap.functions import band_rank, cancel_cause, flight_band, ratio
from aerolap.schema import BAND_CANCELLED, BAND_COLUMNS, CANCEL_CAUSES, DELAY_CAUSE_COLUMNS
from aerolap.sources.files import materialise

KEYS = ["origin", "month", "band"]


def _in_report() -> Column:
    """Flights that have a band; plain comparisons so Parquet can push it."""
    c, d = F.col("cancelled"), F.col("dep_delay")
    return (c == 1) | ((c == 0) & d.isNotNull() & (d > 0))


def _delayed() -> Column:
    d = F.col("dep_delay")
    return (F.col("cancelled") == 0) & d.isNotNull() & (d > 0)


def _order(df: DataFrame) -> DataFrame:
    return df.orderBy("origin", "month", band_rank("band"))


# ---------------------------------------------------------------------------
# Single pass
# ---------------------------------------------------------------------------

def _pairs_sql(names) -> str:
    """SQL array of (neg count, cause, count) structs for the given causes."""
    return "array(" + ", ".join(
        f"named_struct('neg', -`_n_{n}`, 'cause', '{n}', 'cause_count', `_n_{n}`)" for n in names
    ) + ")"


_CAUSES = (f"CASE WHEN band = '{BAND_CANCELLED}' THEN {_pairs_sql(CANCEL_CAUSES.values())} "
           f"ELSE {_pairs_sql(DELAY_CAUSE_COLUMNS)} END")


def _top_k_sql(k: int) -> str:
    """First ``k`` non-zero causes of a group, count desc then cause asc.

    One SQL expression (parsed once) over the per-group counters: the
    group's vocabulary is chosen by its band, zero counts are dropped, the
    structs sort by (-count, cause) and the first ``k`` are kept.
    """
    return (f"transform(slice(array_sort(filter({_CAUSES}, s -> s.cause_count > 0)), 1, {int(k)}), "
            "s -> named_struct('cause', s.cause, 'cause_count', s.cause_count))")


_COUNTERS = [f"_n_{c}" for c in (*DELAY_CAUSE_COLUMNS, *CANCEL_CAUSES.values())]


def band_states(flights: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Mergeable rows: per group (and ``extra`` keys) flights, delay sums and counts, and a
    counter per cause."""
    delays = [F.expr(f"count_if(`{c}` > 0) AS `_n_{c}`") for c in DELAY_CAUSE_COLUMNS]
    codes = [F.expr(f"count_if(cancellation_code = '{code}') AS `_n_{cause}`")
             for code, cause in CANCEL_CAUSES.items()]
    return _banded(flights, extra).groupBy(*extra, *KEYS).agg(
        F.count(F.lit(1)).alias("num_flights"),
        F.sum("dep_delay").alias("_dep_sum"), F.count("dep_delay").alias("_dep_cnt"),
        F.sum("arr_delay").alias("_arr_sum"), F.count("arr_delay").alias("_arr_cnt"),
        *delays, *codes)


def band_report_of(states: DataFrame, k: int = 3) -> DataFrame:
    """A2 from any number of states, in any order (see ``operators.states``)."""
    sums = ["num_flights", "_dep_sum", "_dep_cnt", "_arr_sum", "_arr_cnt", *_COUNTERS]
    return _order(_report(states.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in sums]), k))


def band_report(flights: DataFrame, k: int = 3, ordered: bool = True) -> DataFrame:
    """A2 in one scan and one aggregation (see the module note)."""
    out = _report(band_states(flights), k)
    return _order(out) if ordered else out


def _report(g: DataFrame, k: int) -> DataFrame:
    """The report, from one state per group."""
    flown = f"band <> '{BAND_CANCELLED}'"
    return g.selectExpr(
        *KEYS,
        "num_flights",
        f"CASE WHEN {flown} THEN round(try_divide(_dep_sum, _dep_cnt), 2) END AS avg_dep_delay",
        f"CASE WHEN {flown} THEN round(try_divide(_arr_sum, _arr_cnt), 2) END AS avg_arr_delay",
        f"{_top_k_sql(k)} AS _top",
    ).selectExpr(
        *KEYS,
        "num_flights",
        "avg_dep_delay",
        "avg_arr_delay",
        # empty -> null; a null key has no causes (the reference's join misses it)
        "CASE WHEN size(_top) > 0 AND origin IS NOT NULL AND month IS NOT NULL "
        "THEN _top END AS top_causes",
    )


# ---------------------------------------------------------------------------
# Parts of the report
# ---------------------------------------------------------------------------

def _banded(flights: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    return flights.select(*extra, *BAND_COLUMNS).filter(_in_report()).withColumn(
        "band", flight_band("cancelled", "dep_delay"))


def group_stats(flights: DataFrame) -> DataFrame:
    """Flights and rounded mean delays of every band; cancelled flights have no means."""
    flown = F.col("band") != BAND_CANCELLED
    return _banded(flights).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("num_flights"),
        *[F.round(F.avg(F.when(flown, F.col(c))), 2).alias(f"avg_{c}")
          for c in ("dep_delay", "arr_delay")])


def band_stats(flights: DataFrame) -> DataFrame:
    """The statistics of delayed flights."""
    return group_stats(flights.filter(_delayed()))


def cancel_stats(flights: DataFrame) -> DataFrame:
    """The statistics of cancelled flights (means are null by contract)."""
    return group_stats(flights.filter(F.col("cancelled") == 1))


def union_causes(flights: DataFrame) -> DataFrame:
    """One row per cause of each flight in the report, from one scan.

    A delayed flight has a cause per positive cause column, a cancelled one
    the cause of its code (none for an unknown code).
    """
    delayed = F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in DELAY_CAUSE_COLUMNS])
    of_flight = F.when(F.col("band") == BAND_CANCELLED,
                       F.array(cancel_cause("cancellation_code"))).otherwise(delayed)
    return _banded(flights).select(*KEYS, F.explode(F.array_compact(of_flight)).alias("cause"))


def delay_causes(flights: DataFrame) -> DataFrame:
    """The causes of delayed flights."""
    return union_causes(flights.filter(_delayed()))


def cancel_causes(flights: DataFrame) -> DataFrame:
    """A2d: the causes of cancelled flights."""
    return union_causes(flights.filter(F.col("cancelled") == 1))


def cause_counts(flights: DataFrame) -> DataFrame:
    """A2e / G6: flights per (origin, month, band, cause).

    The causes are counters of one aggregation over the flights; they are
    unpivoted after it, so no flight is multiplied before the shuffle.
    """
    return band_states(flights).selectExpr(
        *KEYS, f"inline(filter({_CAUSES}, s -> s.cause_count > 0))").drop("neg")


def top_causes(flights: DataFrame, k: int = 3) -> DataFrame:
    """A2e / W1 / G5: first ``k`` causes per group, count desc then cause asc."""
    return band_states(flights).selectExpr(*KEYS, f"{_top_k_sql(k)} AS top_causes").where(
        "size(top_causes) > 0")


def band_report_joined(flights: DataFrame, k: int = 3, ordered: bool = True) -> DataFrame:
    """A2 in join form (J1): the groups' statistics left-joined to their causes.

    Both sides read the same written aggregate, so the flights are scanned
    once; a null key finds no causes, as an equality join has it.
    """
    groups = materialise(band_states(flights), "band_groups")
    causes = groups.selectExpr(*KEYS, f"{_top_k_sql(k)} AS top_causes").where(
        "size(top_causes) > 0")
    flown = F.col("band") != BAND_CANCELLED
    stats = groups.select(*KEYS, "num_flights",
                          F.when(flown, F.round(ratio("_dep_sum", "_dep_cnt"), 2)).alias("avg_dep_delay"),
                          F.when(flown, F.round(ratio("_arr_sum", "_arr_cnt"), 2)).alias("avg_arr_delay"))
    out = stats.join(causes, KEYS, "left")
    return _order(out) if ordered else out
