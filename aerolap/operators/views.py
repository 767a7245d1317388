"""Inspection views over the analysis results.

They read written results. "The first N carriers / airports" is
``distinct().orderBy().limit(N)`` joined back null-safe, and limits per key are
window ranks over the few rows of a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolap.functions import band_rank, month_name

CARRIER = "op_unique_carrier"


def first_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` distinct values of ``key`` in sort order; null is one, the first."""
    return df.select(key).distinct().orderBy(F.col(key).asc_nulls_first()).limit(n)


def _restrict(df: DataFrame, key: str, values: Sequence[str | None] | None, n: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``values``, or in the first ``n`` keys (null-safe)."""
    if values is not None:
        named = F.col(key).isin([v for v in values if v is not None])
        return df.filter((named | F.col(key).isNull()) if None in values else named)
    keys = first_keys(df, key, n).select(F.col(key).alias("_first_key"))
    return df.join(keys, F.col(key).eqNullSafe(F.col("_first_key")), "left_semi")


def top_routes(stats: DataFrame, carriers: Sequence[str] | None = None, n_carriers: int = 3,
               n: int = 10) -> DataFrame:
    """Top ``n`` routes by flights for chosen carriers (default: first 3).

    Ties on flights are broken by route, so the result is repeatable.
    """
    sel = _restrict(stats, CARRIER, carriers, n_carriers)
    w = Window.partitionBy(CARRIER).orderBy(F.col("num_flights").desc(), F.col("route").asc())
    return (
        sel.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= n)
        .select(CARRIER, "position", "route", "num_flights", "avg_arr_delay", "cancel_rate",
                "months")
        .orderBy(CARRIER, "position")
    )


def route_counts(stats: DataFrame) -> DataFrame:
    """Number of routes per carrier."""
    return stats.groupBy(CARRIER).agg(F.count(F.lit(1)).alias("num_routes")).orderBy(CARRIER)


def band_view(report: DataFrame, airports: Sequence[str] | None = None, n_airports: int = 3,
              n_months: int = 3) -> DataFrame:
    """Bands of the first months of chosen airports, in band order.

    A group without causes shows an empty list instead of null.
    """
    sel = _restrict(report, "origin", airports, n_airports)
    w = Window.partitionBy("origin").orderBy(F.col("month").asc_nulls_first())
    view = sel.withColumn("_m", F.dense_rank().over(w)).filter(F.col("_m") <= n_months)
    return (
        view.select(
            "origin",
            "month",
            month_name("month").alias("month_name"),
            "band",
            "num_flights",
            "avg_dep_delay",
            "avg_arr_delay",
            F.coalesce(
                "top_causes", F.array().cast("array<struct<cause:string,cause_count:bigint>>")
            ).alias("top_causes"),
        )
        .orderBy("origin", "month", band_rank("band"))
    )


def ranking_view(ranking: DataFrame, airports: Sequence[str] | None = None, n_airports: int = 3,
                 n: int = 10) -> DataFrame:
    """The best ``n`` carriers of chosen airports (default: first 3)."""
    sel = _restrict(ranking, "origin", airports, n_airports)
    return (
        sel.filter(F.col("rank") <= n)
        .select("origin", CARRIER, "num_flights", "avg_arr_delay", "avg_dep_delay",
                "cancel_rate", "dep_delay_diff", "rank")
        .orderBy("origin", "rank")
    )


def ranking_summary(ranking: DataFrame) -> DataFrame:
    """Airports, rows, and rows per airport of a ranking."""
    return ranking.agg(
        F.count_distinct("origin").alias("total_airports"),
        F.count(F.lit(1)).alias("total_rows"),
    ).withColumn("rows_per_airport", F.try_divide(F.col("total_rows").cast("double"),
                                                  F.col("total_airports")))


def distinct_summary(stats: DataFrame) -> DataFrame:
    """Distinct carriers, routes and (carrier, route) pairs of route statistics."""
    return stats.agg(
        F.count_distinct(CARRIER).alias("num_carriers"),
        F.count_distinct("route").alias("num_routes"),
        F.count(F.lit(1)).alias("num_rows"),
    )


def profile(results: Mapping[str, DataFrame]) -> DataFrame:
    """I4: row and column count of each named result, one row per result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("result"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in results.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
