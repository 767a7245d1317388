"""Key -> oracle SQL text, for the keys of ``plans.catalog.QUERIES``."""

from __future__ import annotations

from aerolap.plans import oracle as O
from aerolap.plans.catalog import FILTER_CARRIERS, FILTER_ORIGINS
from aerolap.schema import BAND_COLUMNS, RANKING_COLUMNS

# Keys whose result has the date column ``fl_date``: given as ISO text.
DATE_KEYS = {"scan_csv", "scan_parquet", "clean_flights", "scale_identity", "scale_replicate_2",
             "scale_replicate_4", "dq_bad_rows", "scale_sample", "scan_csv_by_name",
             "scan_csv_decimal_ints", "scan_csv_quoted", "scan_csv_inferred", "scale_exact_sample",
             "sink_replace_partitions"}


def _date_text(sql: str) -> str:
    return f"SELECT * REPLACE (CAST(fl_date AS VARCHAR) AS fl_date) FROM ({sql})"


ORACLE_SQL: dict[str, str] = {
    "route_stats": O.ROUTE_STATS,
    "origin_stats": O.ORIGIN_STATS,
    "route_months": O.ROUTE_MONTHS,
    "band_report": O.BAND_REPORT,
    "join_band_causes": O.BAND_REPORT,
    "band_stats": O.BAND_STATS,
    "cancel_stats": O.CANCEL_STATS,
    "delay_causes": O.DELAY_CAUSES,
    "cancel_causes": O.CANCEL_CAUSES,
    "union_causes": O.UNION_CAUSES,
    "cause_counts": O.CAUSE_COUNTS,
    "top_causes": O.TOP_CAUSES,
    "carrier_ranking": O.CARRIER_RANKING,
    "join_airport_baseline": O.CARRIER_RANKING,
    "airport_baseline": O.AIRPORT_BASELINE,
    "dq_row_count": O.DQ_ROW_COUNT,
    "dq_null_report": O.DQ_NULL_REPORT,
    "dq_dist_cancelled": O.dq_dist("cancelled"),
    "dq_dist_diverted": O.dq_dist("diverted"),
    "dq_flags_cancelled": O.dq_flags("cancelled"),
    "dq_flags_diverted": O.dq_flags("diverted"),
    "dq_describe_cancelled": O.dq_describe("cancelled"),
    "dq_describe_diverted": O.dq_describe("diverted"),
    "dq_sample_cancelled": O.DQ_SAMPLE_CANCELLED,
    "dq_bad_month": O.DQ_BAD_MONTH,
    "dq_dist_month": O.DQ_DIST_MONTH,
    "dq_split": O.DQ_SPLIT,
    "dq_minutes": O.DQ_MINUTES,
    "dq_expected": O.DQ_EXPECTED,
    "dq_time_checks": O.DQ_TIME_CHECKS,
    "dq_validation_report": O.DQ_VALIDATION_REPORT,
    "dq_bad_rows": O.DQ_BAD_ROWS,
    "dq_error_examples": O.DQ_ERROR_EXAMPLES,
    "clean_codes": O.CLEAN_CODES,
    "clean_casts": O.CLEAN_CASTS,
    "clean_flights": O.CLEAN_FLIGHTS,
    "route_key": O.ROUTE_KEY,
    "band_classify": O.BAND_CLASSIFY,
    "cancel_cause_map": O.CANCEL_CAUSE_MAP,
    "round_half_up": O.ROUND_HALF_UP,
    "null_predicates": O.NULL_PREDICATES,
    "filter_delayed": O.FILTER_DELAYED,
    "filter_keys": O.filter_keys(FILTER_CARRIERS, FILTER_ORIGINS),
    "month_names": O.MONTH_NAMES_SQL,
    "agg_basic": O.AGG_BASIC,
    "scale_identity": O.SCALE_IDENTITY,
    "scale_replicate_2": O.replicate(2),
    "scale_replicate_4": O.replicate(4),
    "scale_manifest": O.SCALE_MANIFEST,
    "scan_csv": O.SCAN_CSV,
    "scan_parquet": O.SCAN_PARQUET,
    "scan_pruned": O.select_flights(BAND_COLUMNS),
    "scan_declared": O.select_flights(RANKING_COLUMNS),
    "sink_parquet": O.ROUTE_STATS,
    "sink_table": O.CARRIER_RANKING,
    "sink_insert_overwrite": O.BAND_REPORT,
    "sink_csv": O.DQ_VALIDATION_REPORT,
    "scale_sample": O.SCALE_SAMPLE,
    "scan_csv_by_name": O.SCAN_CSV,
    "scan_csv_decimal_ints": O.SCAN_CSV,
    "scan_csv_quoted": O.SCAN_CSV_QUOTED,
    "dq_minutes_dirty": O.DQ_MINUTES_DIRTY,
    "route_stats_nulls": O.with_nulls(O.ROUTE_STATS),
    "band_report_nulls": O.with_nulls(O.BAND_REPORT),
    "carrier_ranking_nulls": O.with_nulls(O.CARRIER_RANKING),
    "inspect_bands_nulls": O.with_nulls(O.INSPECT_BANDS),
    "inspect_top_routes": O.INSPECT_TOP_ROUTES,
    "inspect_route_counts": O.INSPECT_ROUTE_COUNTS,
    "inspect_bands": O.INSPECT_BANDS,
    "inspect_ranking": O.INSPECT_RANKING,
    "inspect_distinct": O.INSPECT_DISTINCT,
    "inspect_ranking_summary": O.INSPECT_RANKING_SUMMARY,
    "inspect_profile": O.INSPECT_PROFILE,
    "inspect_variants": O.INSPECT_VARIANTS,
    "dq_bad_rows_lines": O.DQ_BAD_ROWS_LINES,
    "scan_csv_inferred": O.SCAN_CSV,
    "scan_csv_widened": O.SCAN_CSV_WIDENED,
    "scale_exact_sample": O.SCALE_EXACT_SAMPLE,
    "scale_sizes": O.SCALE_SIZES,
    "sink_replace_partitions": O.SINK_REPLACE_PARTITIONS,
    "route_months_wide": O.ROUTE_MONTHS_WIDE,
    "route_stats_states": O.with_later_arrivals(O.ROUTE_STATS),
    "band_report_states": O.with_later_arrivals(O.BAND_REPORT),
    "carrier_ranking_states": O.with_later_arrivals(O.CARRIER_RANKING),
}
ORACLE_SQL = {k: (_date_text(v) if k in DATE_KEYS else v) for k, v in ORACLE_SQL.items()}
