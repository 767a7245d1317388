"""Text forms of nested and date result columns, for engine-neutral comparison.

The library returns ``array<int>``, ``array<struct<cause, cause_count>>`` and
``date``; registered queries expose them as ``1,2,3``,
``cause:count|cause:count`` and ISO ``yyyy-MM-dd`` text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def int_list_text(c: str) -> Column:
    return F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",")


def cause_list_text(c: str) -> Column:
    return F.array_join(
        F.transform(
            F.col(c), lambda s: F.concat(s["cause"], F.lit(":"), s["cause_count"].cast("string"))
        ),
        "|",
    )


def with_text(df: DataFrame, ints: tuple[str, ...] = (), causes: tuple[str, ...] = ()) -> DataFrame:
    """Replace the named nested columns by their text form, in place."""
    out = []
    for c in df.columns:
        if c in ints:
            out.append(int_list_text(c).alias(c))
        elif c in causes:
            out.append(cause_list_text(c).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Date columns as ISO text, in place; other columns unchanged."""
    if not any(isinstance(f.dataType, T.DateType) for f in df.schema.fields):
        return df
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
