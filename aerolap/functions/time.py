"""HHMM clock arithmetic as built-in Column expressions (Q12-Q15).

All functions take and return Columns, so they stay inside whole-stage
codegen. A null input gives a null output, except ``timezone_ok`` where a
null means "not ok" (a missing value fails a check).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolap.functions._util import col_of, text_number

MINUTES_PER_DAY = 1440
HALF_DAY = 720


def hhmm_to_minutes(c, numeric: bool = False) -> Column:
    """HHMM clock value -> minutes after midnight; 2400 -> 1440.

    Floor division and a non-negative remainder; text that is not a plain
    number becomes null (``12d`` included). ``numeric`` says that the column
    holds numbers, which need no look at their text; NaN and infinity become null.
    """
    if numeric:
        x = col_of(c).cast("double")
        x = F.when(F.abs(x) < float("inf"), x)
    else:
        x = text_number(col_of(c).cast("string"))
    return F.floor(x / 100).cast("double") * 60 + F.pmod(x, F.lit(100.0))


def wrap_24h(c) -> Column:
    """Map a minute difference into [-720, 720) modulo one day."""
    return F.pmod(col_of(c) + HALF_DAY, F.lit(MINUTES_PER_DAY)) - HALF_DAY


def elapsed(start, end) -> Column:
    """Minutes from ``start`` to ``end`` clock minutes, crossing midnight once."""
    d = col_of(end) - col_of(start)
    return F.when(d < 0, d + MINUTES_PER_DAY).otherwise(d)


def timezone_ok(expected, actual) -> Column:
    """True when ``expected - actual`` (wrapped) is a whole number of hours.

    A time-zone shift between two clocks moves the difference by whole hours
    only. A null on either side is not ok.
    """
    diff = wrap_24h(col_of(expected) - col_of(actual))
    return F.coalesce(F.pmod(diff, F.lit(60)) == 0, F.lit(False))
