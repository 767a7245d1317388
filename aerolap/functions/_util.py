from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def text_number(c: Column) -> Column:
    """Text as a double, null unless it is a plain number (``12d`` is not one)."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def looks_plain(c: Column) -> Column:
    """Does the text begin like a number, end with a digit or a dot, and hold no ``x``?

    Of such texts a cast to double takes plain numbers only: what else it takes ends
    with a letter (``12d``, ``-inf``), holds an ``x`` (``0x1p3``) or has blanks or control
    characters around it. Costs a fraction of the pattern.
    """
    last = F.substring(c, -1, 1)
    return ((c >= "+") & (c < ":") & (last >= ".") & (last < ":")
            & ~F.contains(c, F.lit("x")) & ~F.contains(c, F.lit("X")))


def cell_number(c: Column) -> Column:
    """:func:`text_number` of a column of texts that mostly look plain."""
    return F.when(looks_plain(c) | c.rlike(_NUMBER), c.try_cast("double"))


def lenient(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast with the non-ANSI meaning: a bad value becomes null, and text such
    as ``1.0`` becomes the integer 1 (truncated) rather than null."""
    if isinstance(source, T.StringType) and isinstance(target, T.NumericType):
        c = text_number(c)
    return c.try_cast(target)
