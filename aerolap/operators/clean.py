"""Cleaning of the raw flight table.

Each step is a lazy ``DataFrame -> DataFrame`` that rewrites columns in
place (same order); all other columns pass through. Compose with
``df.transform``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.functions import normalise_code
from aerolap.functions._util import lenient
from aerolap.schema import CLEAN_OVERRIDES, CODE_COLUMNS


def _replace(df: DataFrame, exprs: Mapping[str, object]) -> DataFrame:
    """Replace columns by name, keeping the column order."""
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def normalise_codes(df: DataFrame, columns: Sequence[str] = CODE_COLUMNS) -> DataFrame:
    """Carrier and airport codes -> ``upper(trim(x))``."""
    return _replace(df, {c: normalise_code(c) for c in columns if c in df.columns})


def lenient_cast(df: DataFrame, column: str, target: T.DataType):
    """:func:`aerolap.functions.lenient` of a column of ``df``."""
    return lenient(F.col(column), df.schema[column].dataType, target)


def cast_types(df: DataFrame, types: Mapping[str, T.DataType] = CLEAN_OVERRIDES) -> DataFrame:
    """Month and flags -> int, delays -> double; bad values -> null."""
    return _replace(df, {c: lenient_cast(df, c, t) for c, t in types.items() if c in df.columns})


def void_delays(df: DataFrame) -> DataFrame:
    """C3 + C4: a cancelled flight has no departure delay; a cancelled or
    diverted flight has no arrival delay. A null flag keeps the value."""
    canc, div = F.col("cancelled"), F.col("diverted")
    return _replace(
        df,
        {
            "dep_delay": F.when(canc == 1, F.lit(None).cast("double")).otherwise(F.col("dep_delay")),
            "arr_delay": F.when((canc == 1) | (div == 1), F.lit(None).cast("double")).otherwise(
                F.col("arr_delay")
            ),
        },
    )


def clean(raw: DataFrame) -> DataFrame:
    """The full cleaning, C1 -> C2 -> C3/C4, as one projection."""
    return raw.transform(normalise_codes).transform(cast_types).transform(void_delays)
