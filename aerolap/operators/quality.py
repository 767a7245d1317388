"""Data-quality checks on the raw flight table (Q1-Q11).

Each check is one lazy aggregation (or filter) over the table: a whole
profile is one pass with many aggregate columns, turned into rows with
``inline`` afterwards, rather than one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.functions import ratio


def _is_missing(df: DataFrame, c: str) -> Column:
    """Null, or NaN in a floating column (both count as missing)."""
    col = F.col(c)
    dt = df.schema[c].dataType
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def row_count(df: DataFrame) -> DataFrame:
    """Q1: number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Q3: rows per value of ``column``, the null value included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("num_rows"))


def flag_profile(df: DataFrame, column: str) -> DataFrame:
    """Q4: total rows and rows where the flag is 1, 0 or null, one row."""
    c = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(c == 1).alias(f"{column}_1"),
        F.count_if(c == 0).alias(f"{column}_0"),
        F.count_if(c.isNull()).alias(f"{column}_null"),
    )


DESCRIBE_METRICS = ["count", "mean", "stddev", "min", "max"]


def describe_subset(df: DataFrame, flag: str, columns: Sequence[str]) -> DataFrame:
    """Q5: count, mean, sample stddev, min, max of ``columns`` where flag = 1.

    Long form ``(column, metric, value)`` with typed doubles (``describe()``
    returns strings).
    """
    sub = df.filter(F.col(flag) == 1)
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).cast("double").alias(f"{c}|count"),
            F.avg(x).alias(f"{c}|mean"),
            F.stddev_samp(x).alias(f"{c}|stddev"),
            F.min(x).alias(f"{c}|min"),
            F.max(x).alias(f"{c}|max"),
        ]
    one = sub.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(m).alias("metric"),
                 F.col(f"`{c}|{m}`").alias("value"))
        for c in columns for m in DESCRIBE_METRICS
    ])
    return one.select(F.inline(rows))


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q2 + Q6: per column, null count and share in percent (4 decimals).

    One aggregation for all columns; sorted by count desc, then column name.
    """
    cols = list(columns or df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(_is_missing(df, c)).alias(f"_n{i}") for i, c in enumerate(cols)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ])
    return (
        one.select("_total", F.inline(rows))
        .select(
            "column",
            "null_count",
            F.round(ratio("null_count", "_total") * 100, 4).alias("null_percentage"),
        )
        .orderBy(F.col("null_count").desc(), F.col("column").asc())
    )


def bad_months(df: DataFrame) -> DataFrame:
    """Q9: rows whose month is present but outside 1..12."""
    m = F.col("month").try_cast("int")
    return df.filter(m.isNotNull() & ((m < 1) | (m > 12)))


def month_distribution(df: DataFrame) -> DataFrame:
    """Q10: rows per month (as int), in month order."""
    return (
        df.select(F.col("month").try_cast("int").alias("month"))
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .orderBy("month")
    )


def split_counts(df: DataFrame) -> DataFrame:
    """Q11: rows removed by the time checks (cancelled or diverted) and kept
    (both flags 0); a null flag is in neither."""
    c, d = F.col("cancelled"), F.col("diverted")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if((c == 1) | (d == 1)).alias("removed_rows"),
        F.count_if((c == 0) & (d == 0)).alias("kept_rows"),
    )


def sample_rows(df: DataFrame, flag: str, keys: Sequence[str], columns: Sequence[str],
                n: int = 10) -> DataFrame:
    """Q7: first ``n`` rows with flag = 1 in key order (repeatable).

    ``orderBy().limit()`` plans as a per-partition top-n and a merge of
    ``n`` rows per task; nothing unbounded reaches the driver.
    """
    shown = list(keys) + [c for c in columns if c not in keys]
    return df.filter(F.col(flag) == 1).select(*shown).orderBy(*shown).limit(n)


def schema_frame(df: DataFrame) -> DataFrame:
    """Q8: the schema as rows ``(position, column, type)`` (metadata only)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")
