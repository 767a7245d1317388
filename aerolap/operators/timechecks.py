"""Time-consistency checks of the raw flight table (Q12-Q21).

For flights that were neither cancelled nor diverted, recompute delays,
taxi and air times from the HHMM clock columns and compare with the stored
values. Clocks of different airports are in different time zones, so a
difference of whole hours is accepted; anything else, or a missing value,
is an error. The component check (taxi out + air + taxi in = elapsed) needs
no clocks and has no time-zone slack.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.functions import elapsed, hhmm_to_minutes, timezone_ok, wrap_24h
from aerolap.operators._rows import keep_where
from aerolap.schema import EXAMPLE_FIELDS, FLIGHT_KEYS, TIME_CHECKS

#: Stored field -> (start clock, end clock, how the minutes between them count).
RULES = {
    "dep_delay": ("crs_dep_time", "dep_time", "signed"),
    "arr_delay": ("crs_arr_time", "arr_time", "signed"),
    "taxi_out": ("dep_time", "wheels_off", "forward"),
    "taxi_in": ("wheels_on", "arr_time", "forward"),
    "air_time": ("wheels_off", "wheels_on", "forward"),
    "actual_elapsed_time": ("dep_time", "arr_time", "forward"),
}
_MINUTES = {
    "signed": lambda start, end: wrap_24h(end - start),
    "forward": elapsed,
}
EXPECTED = {field: f"expected_{field}" for field in RULES}
_BUCKETS = 64


def flown(df: DataFrame) -> DataFrame:
    """Rows entering the checks: both flags 0 (a null flag is left out)."""
    return df.filter((F.col("cancelled") == 0) & (F.col("diverted") == 0))


def with_expected(raw: DataFrame) -> DataFrame:
    """Q16: add an expected value per rule, computed from its two clocks."""
    def minutes(clock: str):
        return hhmm_to_minutes(clock, isinstance(raw.schema[clock].dataType, T.NumericType))

    return raw.select("*", *[
        _MINUTES[how](minutes(start), minutes(end)).alias(EXPECTED[field])
        for field, (start, end, how) in RULES.items()])


def with_time_checks(raw: DataFrame) -> DataFrame:
    """Q17 + Q18: flown rows with the expected values and seven error flags
    (``err_<check>``) plus ``any_error``. NaN counts as missing, and a missing
    value is an error."""
    e = with_expected(flown(raw))
    flags = {
        f"err_{field}": ~timezone_ok(F.col(calc), F.col(field).try_cast("double"))
        for field, calc in EXPECTED.items()
    }
    parts = (F.col("taxi_out") + F.col("air_time") + F.col("taxi_in")).cast("double")
    whole = F.col("actual_elapsed_time").cast("double")
    flags["err_components_sum"] = F.coalesce(
        (parts != whole) | F.isnan(parts) | F.isnan(whole), F.lit(True))
    any_error = None
    for name in flags:
        any_error = F.col(name) if any_error is None else (any_error | F.col(name))
    return e.select("*", *[v.alias(k) for k, v in flags.items()]).withColumn("any_error", any_error)


def validation_report(raw: DataFrame) -> DataFrame:
    """Q19: errors per check, seven rows in fixed order ``(position, check, errors)``."""
    checked = with_time_checks(raw)
    one = checked.agg(*[F.count_if(F.col(f"err_{c}")).alias(c) for c in TIME_CHECKS])
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("check"),
                 F.col(c).alias("error_count"))
        for i, c in enumerate(TIME_CHECKS)
    ])
    return one.select(F.inline(rows)).orderBy("position")


def bad_rows(raw: DataFrame) -> DataFrame:
    """Q20: the raw rows (all original columns) that fail any check."""
    return keep_where(with_time_checks(raw).select(*raw.columns, "any_error"), "any_error")


def error_examples(raw: DataFrame, keys: Sequence[str] = FLIGHT_KEYS, n: int = 10,
                   fields: Sequence[str] = EXAMPLE_FIELDS) -> DataFrame:
    """Q21: first ``n`` errors per field in key order, with the two clocks that
    explain it, stored and expected value, their difference, and the field's
    number of errors.

    The errors of all fields are stacked to long form and ranked twice: within
    buckets of the keys' hash first, so that a task sees one bucket of a
    field's errors, then among the at most ``n`` left of each bucket.
    """
    stacked = F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f"err_{f}").alias("is_error"),
                 F.col(RULES[f][0]).cast("double").alias("start_clock"),
                 F.col(RULES[f][1]).cast("double").alias("end_clock"),
                 F.col(f).try_cast("double").alias("stored"),
                 F.col(EXPECTED[f]).alias("expected"))
        for f in fields
    ])
    context = [*keys, *[c for c in ("origin", "dest") if c not in keys]]
    long = (with_time_checks(raw).select(*context, F.inline(stacked)).filter("is_error")
            .withColumn("_bucket", F.pmod(F.hash(*context), F.lit(_BUCKETS))))
    totals = long.groupBy("field").agg(F.count(F.lit(1)).alias("field_errors"))
    order = [*context, "stored", "expected"]
    near = Window.partitionBy("field", "_bucket").orderBy(*order)
    whole = Window.partitionBy("field").orderBy(*order)
    first = long.withColumn("_near", F.row_number().over(near)).filter(F.col("_near") <= n)
    ranked = first.withColumn("example_rank", F.row_number().over(whole)).filter(
        F.col("example_rank") <= n)
    return ranked.join(totals, "field").select(
        "field", *context, "start_clock", "end_clock", "stored", "expected",
        (F.col("expected") - F.col("stored")).alias("diff"), "field_errors", "example_rank")
