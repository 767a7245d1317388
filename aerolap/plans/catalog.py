"""Registry of the queries exposed to the driver.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame computed over
the whole test tables of ``sf_dir``: the raw flight table is derived from
``lineitem`` x ``orders`` and materialised once per input
(``sources.fixtures.load_raw_flights``), cleaned, and handed to the
operator. Nested results are given in their text form (``plans.output``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap import sources as S
from aerolap.functions import (
    cancel_cause,
    delay_band,
    flight_band,
    hhmm_to_minutes,
    month_name,
    route_key,
)
from aerolap.operators import bands as B
from aerolap.operators import compare as C
from aerolap.operators import quality as Q
from aerolap.operators import ranking as R
from aerolap.operators import scale as D
from aerolap.operators import states as ST
from aerolap.operators import timechecks as TC
from aerolap.operators import views as V
from aerolap.operators.clean import cast_types, clean, normalise_codes
from aerolap.operators.routes import origin_stats, route_months, route_stats
from aerolap.plans.output import dates_as_text, with_text
from aerolap.schema import (
    BAND_COLUMNS,
    CLEAN_OVERRIDES,
    CLOCK_COLUMNS,
    CODE_COLUMNS,
    RANKING_COLUMNS,
    RAW_COLUMNS,
    RAW_FIELDS,
    TIME_CHECKS,
)
from aerolap.session import input_bytes, open_writers, scratch_path, shuffles_dropped
from aerolap.sources.fixtures import KEY_COLUMNS
from aerolap.sources.fixtures import load_raw_flights as raw_flights
from aerolap.sources.publish import publish

Query = Callable[[SparkSession, str], DataFrame]


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned flight table of ``sf_dir``."""
    return clean(raw_flights(spark, sf_dir))


def flights_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned flights with nulls in keys and flags (the fixture has none)."""
    gaps = {"origin": "l_orderkey % 13 = 0", "dest": "l_orderkey % 19 = 1",
            "op_unique_carrier": "l_partkey % 23 = 0", "month": "l_partkey % 17 = 0",
            "cancelled": "l_suppkey % 11 = 0"}
    return flights(spark, sf_dir).withColumns(
        {c: F.when(~F.expr(gap), F.col(c)) for c, gap in gaps.items()})


def q_route_stats_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(route_stats(flights_with_nulls(spark, sf_dir)), ints=("months",))


def q_band_report_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(B.band_report(flights_with_nulls(spark, sf_dir)), causes=("top_causes",))


def q_carrier_ranking_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.carrier_ranking(flights_with_nulls(spark, sf_dir))


def q_inspect_bands_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = S.materialise(B.band_report(flights_with_nulls(spark, sf_dir), ordered=False),
                           "band_report")
    return with_text(V.band_view(report), causes=("top_causes",))


def q_route_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(route_stats(flights(spark, sf_dir)), ints=("months",))


def q_origin_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(origin_stats(flights(spark, sf_dir)), ints=("months",))


def q_route_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(route_months(flights(spark, sf_dir)), ints=("months",))


def q_band_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(B.band_report(flights(spark, sf_dir)), causes=("top_causes",))


def q_join_band_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(B.band_report_joined(flights(spark, sf_dir)), causes=("top_causes",))


def q_band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.band_stats(flights(spark, sf_dir))


def q_cancel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.cancel_stats(flights(spark, sf_dir))


def q_delay_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.delay_causes(flights(spark, sf_dir))


def q_cancel_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.cancel_causes(flights(spark, sf_dir))


def q_union_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.union_causes(flights(spark, sf_dir))


def q_cause_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.cause_counts(flights(spark, sf_dir))


def q_top_causes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_text(B.top_causes(flights(spark, sf_dir)), causes=("top_causes",))


def q_carrier_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.carrier_ranking(flights(spark, sf_dir))


def q_join_airport_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.carrier_ranking_joined(flights(spark, sf_dir))


def q_airport_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.airport_baseline(flights(spark, sf_dir))


# --- data quality (raw table) ---------------------------------------------

def q_dq_row_count(spark, sf_dir):
    return Q.row_count(raw_flights(spark, sf_dir))


def q_dq_null_report(spark, sf_dir):
    return Q.null_report(raw_flights(spark, sf_dir).select(*RAW_COLUMNS))


def _dist(col):
    def q(spark, sf_dir):
        return Q.value_distribution(raw_flights(spark, sf_dir), col)
    return q


def _flags(col):
    def q(spark, sf_dir):
        return Q.flag_profile(raw_flights(spark, sf_dir), col)
    return q


def _describe(flag):
    def q(spark, sf_dir):
        d = Q.describe_subset(raw_flights(spark, sf_dir), flag, ["dep_delay", "arr_delay"])
        return d.withColumn("value", F.round("value", 6))
    return q


def q_dq_sample_cancelled(spark, sf_dir):
    return Q.sample_rows(raw_flights(spark, sf_dir), "cancelled", KEY_COLUMNS,
                         ["dep_delay", "arr_delay"], n=10)


def q_dq_bad_month(spark, sf_dir):
    shifted = raw_flights(spark, sf_dir).withColumn("month", F.col("month") + 1)
    return Q.bad_months(shifted).select(*KEY_COLUMNS, "month")


def q_dq_dist_month(spark, sf_dir):
    return Q.month_distribution(raw_flights(spark, sf_dir))


def q_dq_split(spark, sf_dir):
    return Q.split_counts(raw_flights(spark, sf_dir))


# --- time checks (raw table) ------------------------------------------------

def q_dq_minutes(spark, sf_dir):
    raw = raw_flights(spark, sf_dir)
    return raw.select(*KEY_COLUMNS, *[hhmm_to_minutes(c).alias(f"{c}_min") for c in CLOCK_COLUMNS])


def q_dq_minutes_dirty(spark, sf_dir):
    """Clocks as text, some with a letter that a lenient parser would drop."""
    raw = raw_flights(spark, sf_dir)
    tail = F.when(F.col("l_orderkey") % 3 == 0, "d").when(F.col("l_orderkey") % 3 == 1, "").otherwise(
        ".0")
    text = F.concat(F.col("dep_time").cast("int").cast("string"), tail)
    return raw.select(*KEY_COLUMNS, hhmm_to_minutes(text).alias("dep_time_min"))


def q_dq_expected(spark, sf_dir):
    e = TC.with_expected(TC.flown(raw_flights(spark, sf_dir)))
    return e.select(*KEY_COLUMNS, *TC.EXPECTED.values())


def q_dq_time_checks(spark, sf_dir):
    t = TC.with_time_checks(raw_flights(spark, sf_dir))
    return t.select(*KEY_COLUMNS, *[f"err_{c}" for c in TIME_CHECKS], "any_error")


def q_dq_validation_report(spark, sf_dir):
    return TC.validation_report(raw_flights(spark, sf_dir))


def q_dq_bad_rows(spark, sf_dir):
    return TC.bad_rows(raw_flights(spark, sf_dir))


def _with_line_ends(raw: DataFrame) -> DataFrame:
    """City names of two lines, and quotes, in some rows."""
    return raw.withColumn("origin_city_name", F.when(F.col("l_linenumber") == 2, F.concat(
        F.lit('The "big"\n'), F.col("origin_city_name"))).otherwise(F.col("origin_city_name")))


def q_dq_bad_rows_lines(spark, sf_dir):
    """Bad rows with the line and record that they have in their CSV file."""
    raw = _with_line_ends(raw_flights(spark, sf_dir)).withColumn("part", F.col("l_orderkey") % 3)
    # a part's file is written in pieces of some 100 MB of text, in order, and numbered as one;
    # the parts are dealt one after the other, so the disk holds the shuffle files of one
    path, parts = scratch_path(spark, "raw_csv"), [r.part for r in raw.select("part").distinct().collect()]
    pieces = 1 + input_bytes(spark, f"{sf_dir}/lineitem.parquet") // (8 << 20) // max(1, len(parts))
    for part in parts:
        rows = raw.where(F.col("part") == part).drop("part")
        with shuffles_dropped(spark):
            S.write_csv(rows.repartitionByRange(pieces, *KEY_COLUMNS).sortWithinPartitions(*KEY_COLUMNS),
                        f"{path}/part={part}", packed=True)
    bad = TC.bad_rows(S.read_raw_csv_lines(spark, path, schema=FIXTURE_SCHEMA, folders=True))
    return bad.select(*KEY_COLUMNS, "origin_city_name", "source_line", "source_record",
                      F.regexp_extract("source_file", r"part=(\d+)", 1).cast("long").alias("part"))


def q_dq_error_examples(spark, sf_dir):
    return TC.error_examples(raw_flights(spark, sf_dir), keys=KEY_COLUMNS)


# --- cleaning steps -----------------------------------------------------------

def q_clean_codes(spark, sf_dir):
    return normalise_codes(raw_flights(spark, sf_dir)).select(*KEY_COLUMNS, *CODE_COLUMNS)


def q_clean_casts(spark, sf_dir):
    return cast_types(raw_flights(spark, sf_dir)).select(*KEY_COLUMNS, *CLEAN_OVERRIDES)


def q_clean_flights(spark, sf_dir):
    return flights(spark, sf_dir)


# --- scalar functions, filters, basic aggregates --------------------------

def q_route_key(spark, sf_dir):
    return flights(spark, sf_dir).select(*KEY_COLUMNS, route_key("origin", "dest").alias("route"))


def q_band_classify(spark, sf_dir):
    return flights(spark, sf_dir).select(
        *KEY_COLUMNS, "dep_delay",
        delay_band("dep_delay").alias("band"),
        flight_band("cancelled", "dep_delay").alias("report_band"),
    )


def q_cancel_cause_map(spark, sf_dir):
    return flights(spark, sf_dir).select(
        *KEY_COLUMNS, "cancellation_code", cancel_cause("cancellation_code").alias("cause")
    )


def q_round_half_up(spark, sf_dir):
    g = flights(spark, sf_dir).groupBy("origin", "op_unique_carrier").agg(
        F.avg("arr_delay").alias("_a")
    )
    return g.select("origin", "op_unique_carrier",
                    *[F.round("_a", n).alias(f"avg_arr_delay_r{n}") for n in range(4)])


def q_null_predicates(spark, sf_dir):
    return flights(spark, sf_dir).groupBy("origin").agg(
        F.count_if(F.col("dep_delay").isNull()).alias("dep_delay_nulls"),
        F.count_if(F.col("dep_delay").isNotNull()).alias("dep_delay_values"),
        F.sum(F.coalesce("arr_delay", F.lit(0.0))).alias("arr_delay_sum_or_zero"),
        F.count_if(F.col("cancellation_code").isNull()).alias("code_nulls"),
    )


def q_filter_delayed(spark, sf_dir):
    f = flights(spark, sf_dir)
    d = F.col("dep_delay")
    return f.filter((F.col("cancelled") == 0) & d.isNotNull() & (d > 0)).select(
        *KEY_COLUMNS, "origin", "month", "dep_delay"
    )


FILTER_CARRIERS = ["C1", "C5", "C7"]
FILTER_ORIGINS = ["A3", "A10", "A17"]


def q_filter_keys(spark, sf_dir):
    f = flights(spark, sf_dir)
    return f.filter(
        F.col("op_unique_carrier").isin(FILTER_CARRIERS) & F.col("origin").isin(FILTER_ORIGINS)
    ).select(*KEY_COLUMNS, "op_unique_carrier", "origin", "dest", "arr_delay")


def q_month_names(spark, sf_dir):
    return flights(spark, sf_dir).groupBy("month").agg(
        F.count(F.lit(1)).alias("num_flights")
    ).select("month", month_name("month").alias("month_name"), "num_flights")


def q_agg_basic(spark, sf_dir):
    return flights(spark, sf_dir).groupBy("origin").agg(
        F.count(F.lit(1)).alias("num_flights"),
        F.min("arr_delay").alias("min_arr_delay"),
        F.max("arr_delay").alias("max_arr_delay"),
        F.avg("arr_delay").alias("avg_arr_delay"),
        F.sum("arr_delay").alias("sum_arr_delay"),
    )


# --- scaling --------------------------------------------------------------

def q_scale_sample(spark, sf_dir):
    return D.keyed_sample(flights(spark, sf_dir), 0.25, KEY_COLUMNS)


def q_scale_exact_sample(spark, sf_dir):
    return D.exact_sample(flights(spark, sf_dir), 0.25, KEY_COLUMNS)


def q_scale_sizes(spark, sf_dir):
    """Every dataset size, written in one pass: rows and the sum of a key of each."""
    paths = D.write_sizes(flights(spark, sf_dir), scratch_path(spark, "datasets"), keys=KEY_COLUMNS)
    parts = [spark.read.parquet(p).agg(
        F.lit(S.size_label(s)).alias("label"), F.count(F.lit(1)).alias("row_count"),
        F.sum("l_orderkey").alias("key_sum")) for s, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_scale_identity(spark, sf_dir):
    return D.scale(flights(spark, sf_dir), 1)


def q_scale_replicate_2(spark, sf_dir):
    return D.scale(flights(spark, sf_dir), 2)


def q_scale_replicate_4(spark, sf_dir):
    return D.scale(flights(spark, sf_dir), 4)


def q_scale_manifest(spark, sf_dir):
    base = scratch_path(spark, "datasets")
    paths = D.write_sizes(flights(spark, sf_dir), base, sizes=[1, 2, 4])
    return D.manifest(spark, paths)


# --- sources and sinks ----------------------------------------------------

FIXTURE_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c != "l_linenumber" else T.IntegerType(), True)
     for c in KEY_COLUMNS]
    + [T.StructField(n, t, True) for n, t in RAW_FIELDS]
)


def q_scan_csv(spark, sf_dir):
    path = S.write_csv(raw_flights(spark, sf_dir), scratch_path(spark, "raw_csv"))
    return S.read_raw_csv(spark, path, schema=FIXTURE_SCHEMA)


def q_scan_csv_by_name(spark, sf_dir):
    """The file's columns in another order than the schema's."""
    raw = raw_flights(spark, sf_dir)
    path = S.write_csv(raw.select(*reversed(raw.columns)), scratch_path(spark, "raw_csv"))
    return S.read_raw_csv(spark, path, schema=FIXTURE_SCHEMA)


def q_scan_csv_decimal_ints(spark, sf_dir):
    """Whole numbers written as ``12.0``, as data-frame tools do beside missing values."""
    raw = raw_flights(spark, sf_dir)
    text = raw.select(*[
        F.concat(F.col(c).cast("string"), F.lit(".0")).alias(c)
        if isinstance(raw.schema[c].dataType, T.IntegerType) else F.col(c) for c in raw.columns])
    path = S.write_csv(text, scratch_path(spark, "raw_csv"), packed=True)
    return S.read_raw_csv(spark, path, schema=FIXTURE_SCHEMA)


def _with_quotes(raw: DataFrame) -> DataFrame:
    return raw.withColumn("origin_city_name", F.concat(
        F.lit('The "big" '), F.col("origin_city_name"), F.lit('"')))


def q_scan_csv_quoted(spark, sf_dir):
    """Quotes and separators inside values."""
    path = S.write_csv(_with_quotes(raw_flights(spark, sf_dir)), scratch_path(spark, "raw_csv"),
                       packed=True)
    return S.read_raw_csv(spark, path, schema=FIXTURE_SCHEMA)


def q_scan_csv_inferred(spark, sf_dir):
    """Types from the file itself; the table has the declared ones."""
    path = S.write_csv(raw_flights(spark, sf_dir), scratch_path(spark, "raw_csv"), packed=True)
    return S.read_csv_inferred(spark, path)


def q_scan_csv_widened(spark, sf_dir):
    """A second file with halves among the whole numbers and words among the dates."""
    raw = raw_flights(spark, sf_dir).withColumn("fl_date", F.col("fl_date").cast("string"))
    path = scratch_path(spark, "raw_csv")
    odd = F.col("l_linenumber") == 7
    S.write_csv(raw.where(~odd), f"{path}/a", packed=True)
    S.write_csv(raw.where(odd).withColumns({
        "crs_dep_time": F.concat(F.col("crs_dep_time").cast("string"), F.lit(".5")),
        "fl_date": F.lit("unknown")}), f"{path}/b", packed=True)
    return S.read_csv_inferred(spark, [f"{path}/a", f"{path}/b"])


def _cleaned_parquet(spark, sf_dir):
    return S.write_parquet(flights(spark, sf_dir), scratch_path(spark, "flights"))


def q_scan_parquet(spark, sf_dir):
    return S.read_flights(spark, _cleaned_parquet(spark, sf_dir))


def q_scan_pruned(spark, sf_dir):
    return S.read_flights(spark, _cleaned_parquet(spark, sf_dir), columns=BAND_COLUMNS)


def q_scan_declared(spark, sf_dir):
    path = _cleaned_parquet(spark, sf_dir)
    full = spark.read.parquet(path).schema
    declared = T.StructType([full[c] for c in RANKING_COLUMNS])
    return S.read_declared(spark, path, declared)


def q_sink_parquet(spark, sf_dir):
    stats = route_stats(flights(spark, sf_dir))
    path = S.write_parquet(stats, scratch_path(spark, "route_stats"))
    return with_text(spark.read.parquet(path), ints=("months",))


RESULT_DB = "aerolap_results"


def _db(spark):
    return S.ensure_database(spark, RESULT_DB, scratch_path(spark, "db"))


def q_sink_table(spark, sf_dir):
    db = _db(spark)
    S.drop_table(spark, db, "carrier_ranking")
    return S.save_table(R.carrier_ranking(flights(spark, sf_dir)), db, "carrier_ranking",
                        scratch_path(spark, "carrier_ranking"))


def q_sink_insert_overwrite(spark, sf_dir):
    db = _db(spark)
    report = B.band_report(flights(spark, sf_dir))
    S.drop_table(spark, db, "band_report")
    S.declare_table(spark, db, "band_report", report.schema,
                    scratch_path(spark, "band_report"))
    out = S.insert_overwrite(report, db, "band_report")
    return with_text(out, causes=("top_causes",))


REPORT_SCHEMA = T.StructType([
    T.StructField("position", T.IntegerType()),
    T.StructField("check", T.StringType()),
    T.StructField("error_count", T.LongType()),
])


def q_sink_csv(spark, sf_dir):
    rep = TC.validation_report(raw_flights(spark, sf_dir))
    path = S.write_csv(rep, scratch_path(spark, "validation_csv"))
    return S.read_csv(spark, path, REPORT_SCHEMA)


# --- inspection views -----------------------------------------------------

# (over written results, as the jobs leave them)

def _routes(spark, sf_dir):
    return S.materialise(route_stats(flights(spark, sf_dir), ordered=False), "route_stats")


def _report(spark, sf_dir):
    return S.materialise(B.band_report(flights(spark, sf_dir), ordered=False), "band_report")


def _ranking(spark, sf_dir):
    return S.materialise(R.carrier_ranking(flights(spark, sf_dir), ordered=False),
                         "carrier_ranking")


def q_inspect_top_routes(spark, sf_dir):
    return with_text(V.top_routes(_routes(spark, sf_dir)), ints=("months",))


def q_inspect_route_counts(spark, sf_dir):
    return V.route_counts(_routes(spark, sf_dir))


def q_inspect_bands(spark, sf_dir):
    return with_text(V.band_view(_report(spark, sf_dir)), causes=("top_causes",))


def q_inspect_ranking(spark, sf_dir):
    return V.ranking_view(_ranking(spark, sf_dir))


def q_inspect_distinct(spark, sf_dir):
    return V.distinct_summary(_routes(spark, sf_dir))


def q_inspect_ranking_summary(spark, sf_dir):
    return V.ranking_summary(_ranking(spark, sf_dir))


def q_inspect_profile(spark, sf_dir):
    return V.profile({"route_stats": _routes(spark, sf_dir), "band_report": _report(spark, sf_dir),
                      "carrier_ranking": _ranking(spark, sf_dir)})


def q_inspect_variants(spark, sf_dir):
    """Differences of two variants of a report: rows that one lacks, and other counts."""
    left = S.materialise(route_stats(flights(spark, sf_dir), ordered=False), "route_stats")
    left = with_text(left, ints=("months",))
    n = F.col("num_flights")
    right = left.where(n % 7 != 0).withColumns({
        "num_flights": F.when(n % 5 == 1, n + 1).otherwise(n),
        "avg_arr_delay": F.col("avg_arr_delay") + 1e-9})
    extra = left.where(n % 7 == 3).withColumn("route", F.concat("route", F.lit("*")))
    return C.diff(left, right.unionByName(extra), ["op_unique_carrier", "route"],
                  {"avg_arr_delay": 1e-6})


def q_sink_replace_partitions(spark, sf_dir):
    """A partitioned table of which two months are written again."""
    f = flights(spark, sf_dir)
    path = scratch_path(spark, "flights_by_month")
    S.replace_partitions(f, path, ["month"])
    S.replace_partitions(f.where(F.col("month").isin(3, 4)).withColumn(
        "dep_delay", F.col("dep_delay") + 1), path, ["month"])
    return spark.read.schema(f.schema).parquet(path)


def _from_states(analysis: str) -> Query:
    """The analysis from states of input files, after one came and one was written again."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = flights(spark, sf_dir)
        folder, store = scratch_path(spark, "inputs"), scratch_path(spark, "states")
        # one scan writes all inputs, which then come to their folder one by one
        came, line = scratch_path(spark, "came"), F.col("l_linenumber") % 4
        with open_writers(spark, 4):
            f.where(line.between(0, 3)).withColumn("came", line).write.partitionBy("came").parquet(came)
        for part in (0, 1, 2):
            publish(spark, f"{came}/came={part}", f"{folder}/{part}", empty=f.limit(0))
        ST.update(spark, [folder], store, analysis)
        publish(spark, f"{came}/came=3", f"{folder}/3", empty=f.limit(0))
        again = spark.read.schema(f.schema).parquet(f"{folder}/1")
        S.write_parquet(again.withColumn("arr_delay", F.col("arr_delay") + 3), f"{came}/again")
        publish(spark, f"{came}/again", f"{folder}/1")
        ST.update(spark, [folder], store, analysis)
        return with_text(ST.report(spark, store, analysis),
                         ints=("months",) if analysis == "route_stats" else (),
                         causes=("top_causes",) if analysis == "band_report" else ())
    return q


def q_route_months_wide(spark, sf_dir):
    """Month numbers far outside the calendar."""
    wide = flights(spark, sf_dir).withColumn("month", F.col("month") * 37 - 150)
    return with_text(route_months(wide), ints=("months",))


def _neutral(q: Query) -> Query:
    """The query with date columns given as ISO text (see ``plans.output``)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dates_as_text(q(spark, sf_dir))
    run.__name__ = getattr(q, "__name__", "query")
    return run


QUERIES: dict[str, Query] = {
    "route_stats": q_route_stats,
    "origin_stats": q_origin_stats,
    "route_months": q_route_months,
    "band_report": q_band_report,
    "join_band_causes": q_join_band_causes,
    "band_stats": q_band_stats,
    "cancel_stats": q_cancel_stats,
    "delay_causes": q_delay_causes,
    "cancel_causes": q_cancel_causes,
    "union_causes": q_union_causes,
    "cause_counts": q_cause_counts,
    "top_causes": q_top_causes,
    "carrier_ranking": q_carrier_ranking,
    "join_airport_baseline": q_join_airport_baseline,
    "airport_baseline": q_airport_baseline,
    "dq_row_count": q_dq_row_count,
    "dq_null_report": q_dq_null_report,
    "dq_dist_cancelled": _dist("cancelled"),
    "dq_dist_diverted": _dist("diverted"),
    "dq_flags_cancelled": _flags("cancelled"),
    "dq_flags_diverted": _flags("diverted"),
    "dq_describe_cancelled": _describe("cancelled"),
    "dq_describe_diverted": _describe("diverted"),
    "dq_sample_cancelled": q_dq_sample_cancelled,
    "dq_bad_month": q_dq_bad_month,
    "dq_dist_month": q_dq_dist_month,
    "dq_split": q_dq_split,
    "dq_minutes": q_dq_minutes,
    "dq_expected": q_dq_expected,
    "dq_time_checks": q_dq_time_checks,
    "dq_validation_report": q_dq_validation_report,
    "dq_bad_rows": q_dq_bad_rows,
    "dq_error_examples": q_dq_error_examples,
    "clean_codes": q_clean_codes,
    "clean_casts": q_clean_casts,
    "clean_flights": q_clean_flights,
    "route_key": q_route_key,
    "band_classify": q_band_classify,
    "cancel_cause_map": q_cancel_cause_map,
    "round_half_up": q_round_half_up,
    "null_predicates": q_null_predicates,
    "filter_delayed": q_filter_delayed,
    "filter_keys": q_filter_keys,
    "month_names": q_month_names,
    "agg_basic": q_agg_basic,
    "scale_sample": q_scale_sample,
    "scale_identity": q_scale_identity,
    "scale_replicate_2": q_scale_replicate_2,
    "scale_replicate_4": q_scale_replicate_4,
    "scale_manifest": q_scale_manifest,
    "scan_csv": q_scan_csv,
    "scan_parquet": q_scan_parquet,
    "scan_pruned": q_scan_pruned,
    "scan_declared": q_scan_declared,
    "sink_parquet": q_sink_parquet,
    "sink_table": q_sink_table,
    "sink_insert_overwrite": q_sink_insert_overwrite,
    "sink_csv": q_sink_csv,
    "scan_csv_by_name": q_scan_csv_by_name,
    "scan_csv_decimal_ints": q_scan_csv_decimal_ints,
    "scan_csv_quoted": q_scan_csv_quoted,
    "dq_minutes_dirty": q_dq_minutes_dirty,
    "route_stats_nulls": q_route_stats_nulls,
    "band_report_nulls": q_band_report_nulls,
    "carrier_ranking_nulls": q_carrier_ranking_nulls,
    "inspect_bands_nulls": q_inspect_bands_nulls,
    "inspect_top_routes": q_inspect_top_routes,
    "inspect_route_counts": q_inspect_route_counts,
    "inspect_bands": q_inspect_bands,
    "inspect_ranking": q_inspect_ranking,
    "inspect_distinct": q_inspect_distinct,
    "inspect_ranking_summary": q_inspect_ranking_summary,
    "inspect_profile": q_inspect_profile,
    "inspect_variants": q_inspect_variants,
    "dq_bad_rows_lines": q_dq_bad_rows_lines,
    "scan_csv_inferred": q_scan_csv_inferred,
    "scan_csv_widened": q_scan_csv_widened,
    "scale_exact_sample": q_scale_exact_sample,
    "scale_sizes": q_scale_sizes,
    "sink_replace_partitions": q_sink_replace_partitions,
    "route_months_wide": q_route_months_wide,
    "route_stats_states": _from_states("route_stats"),
    "band_report_states": _from_states("band_report"),
    "carrier_ranking_states": _from_states("carrier_ranking"),
}
QUERIES = {k: _neutral(q) for k, q in QUERIES.items()}
