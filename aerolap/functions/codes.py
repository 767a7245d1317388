"""Code, band and label expressions (C1, P3, P5, P6, P19) as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolap.functions._util import col_of
from aerolap.schema import (
    BAND_CANCELLED,
    BAND_HIGH,
    BAND_LOW,
    BAND_MEDIUM,
    BAND_ORDER,
    CANCEL_CAUSES,
    LOW_BELOW,
    MEDIUM_UP_TO,
    MONTH_NAMES,
)


def normalise_code(c) -> Column:
    """Airport / carrier code -> upper case without surrounding blanks."""
    return F.upper(F.trim(col_of(c)))


def route_key(origin, dest) -> Column:
    """``ORIGIN-DEST``; a null side is skipped (``concat_ws`` semantics)."""
    return F.concat_ws("-", col_of(origin), col_of(dest))


def delay_band(dep_delay) -> Column:
    """Band of a late departure: < 15 low, <= 60 medium, else high.

    Only a positive delay has a band; zero, early and null give null.
    """
    d = col_of(dep_delay)
    return (
        F.when(d.isNull() | (d <= 0), F.lit(None).cast("string"))
        .when(d < LOW_BELOW, F.lit(BAND_LOW))
        .when(d <= MEDIUM_UP_TO, F.lit(BAND_MEDIUM))
        .otherwise(F.lit(BAND_HIGH))
    )


def flight_band(cancelled, dep_delay) -> Column:
    """Band of a flight in the band report.

    ``cancelled`` for a cancelled flight, the delay band for a flown flight
    with a positive departure delay, null otherwise (the flight is not in the
    report). A null flag gives null.
    """
    c = col_of(cancelled)
    return F.when(c == 1, F.lit(BAND_CANCELLED)).when(c == 0, delay_band(dep_delay))


def band_rank(band) -> Column:
    """Report order of a band: low 1, medium 2, high 3, anything else 4."""
    b = col_of(band)
    expr = F.when(b == BAND_ORDER[0], F.lit(1))
    for i, name in enumerate(BAND_ORDER[1:3], start=2):
        expr = expr.when(b == name, F.lit(i))
    return expr.otherwise(F.lit(4))


def cancel_cause(code) -> Column:
    """Cancellation code -> cause name; an unknown or null code gives null."""
    c = col_of(code)
    expr = None
    for k, v in CANCEL_CAUSES.items():
        expr = (F.when if expr is None else expr.when)(c == k, F.lit(v))
    return expr


def month_name(month) -> Column:
    """Month number -> English name; another number is kept as its text."""
    m = col_of(month)
    expr = None
    for k, v in MONTH_NAMES.items():
        expr = (F.when if expr is None else expr.when)(m == k, F.lit(v))
    return expr.otherwise(m.cast("string"))


def ratio(numerator, denominator) -> Column:
    """``numerator / denominator`` with null instead of a division-by-zero error."""
    return F.try_divide(col_of(numerator).cast("double"), col_of(denominator))
