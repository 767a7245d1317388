"""Comparison of results that should agree (I4).

Two variants of an analysis are compared without regard to the order of rows or
their files: :func:`digest` folds each into a few numbers that differ if the
bags of rows differ, :func:`diff` names every cell that differs beyond a
tolerance, and every row that only one side has, :func:`overview` shows shape,
schema and first rows of each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def _hash(cols: Sequence[Column], seed: int) -> Column:
    # a null changes nothing in xxhash64, so say where nulls are
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (c, c.isNull())])


def digest(df: DataFrame) -> DataFrame:
    """One row: row_count, and for all columns together and each alone the sum of
    the hashes of the rows (exact, so neither order nor files matter, while
    repeated rows count)."""
    whole = [F.col(f"`{c}`") for c in df.columns]
    total = lambda cols, seed: F.sum(_hash(cols, seed).cast("decimal(38,0)"))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        total(whole, 1).alias("rows_digest"), total(whole, 2).alias("rows_digest_2"),
        F.create_map(*[x for c in df.columns for x in (F.lit(c), total([F.col(f"`{c}`")], 3))])
        .alias("column_digests"))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Do two results hold the same rows, equally often, in columns of the same names?"""
    if sorted(left.columns) != sorted(right.columns):
        return False
    a, b = (digest(d.select(*sorted(d.columns))).drop("column_digests").first() for d in (left, right))
    return a == b


def _numbered(df: DataFrame, keys: Sequence[str], n: str) -> DataFrame:
    """Rows of equal keys numbered by their other columns, so that they pair off."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*(rest or [F.lit(0)]))
    return df.withColumn(n, F.row_number().over(w))


def diff(left: DataFrame, right: DataFrame, keys: Sequence[str],
         tolerances: Mapping[str, float] | float = 0.0) -> DataFrame:
    """Every difference of two results: the keys, ``occurrence``, ``kind``, ``column``, left, right.

    ``kind`` is ``only_left`` or ``only_right`` for a row without a counterpart
    (``column`` null) and ``value`` for a cell. Numbers may differ by the
    tolerance of their column; nulls equal nulls, and NaN equals NaN. Rows of
    equal keys are paired in the order of their other columns.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"different columns: {left.columns} and {right.columns}")
    values = [c for c in left.columns if c not in keys]
    n = "occurrence"
    a = _numbered(left.select(*left.columns), keys, n).select(
        F.struct(*keys, n).alias("ka"), F.struct(*(values or [n])).alias("a"))
    b = _numbered(right.select(*left.columns), keys, n).select(
        F.struct(*keys, n).alias("kb"), F.struct(*(values or [n])).alias("b"))
    same = F.col(f"ka.{n}") == F.col(f"kb.{n}")
    for k in keys:
        same = same & F.col(f"ka.`{k}`").eqNullSafe(F.col(f"kb.`{k}`"))
    pairs = a.join(b, same, "full")
    cell = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "column", "left", "right")])

    def entry(kind: str, column: str | None, x: Column, y: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(column).cast("string").alias("column"),
                        x.alias("left"), y.alias("right")).cast(cell)

    none = F.lit(None).cast("string")
    found = [F.when(F.col("kb").isNull(), entry("only_left", None, none, none)),
             F.when(F.col("ka").isNull(), entry("only_right", None, none, none))]
    for c in values:
        x, y = F.col(f"a.`{c}`"), F.col(f"b.`{c}`")
        equal = x.eqNullSafe(y)
        if isinstance(left.schema[c].dataType, T.NumericType):
            slack = tolerances if isinstance(tolerances, float | int) else tolerances.get(c, 0.0)
            equal = equal | F.coalesce(F.abs(x - y) <= slack, F.lit(False))
        both = F.col("ka").isNotNull() & F.col("kb").isNotNull()
        found.append(F.when(both & ~equal, entry("value", c, x.cast("string"), y.cast("string"))))
    cells = F.filter(F.array(*found), lambda e: e.isNotNull())
    key = F.coalesce("ka", "kb")
    return pairs.select(key.alias("key"), F.inline(cells)).select(
        *[F.col(f"key.`{k}`") for k in keys], F.col(f"key.{n}"), "kind", "column", "left", "right")


def diff_summary(differences: DataFrame) -> DataFrame:
    """Number of differences of each kind and column."""
    return differences.groupBy("kind", "column").agg(F.count(F.lit(1)).alias("differences"))


def overview(results: Mapping[str, DataFrame], n: int = 3) -> DataFrame:
    """One row per named result: row and column count, schema, and the first ``n`` rows
    in the order of their columns, as JSON."""
    parts = []
    for name, df in results.items():
        plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
        first = df.orderBy(*[F.col(f"`{c}`") for c in plain]).limit(n).withColumn(
            "_i", F.monotonically_increasing_id())
        rows = first.agg(F.transform(F.array_sort(F.collect_list(F.struct(
            "_i", F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row")))),
            lambda r: r["row"]).alias("first_rows"))
        counted = df.agg(F.count(F.lit(1)).alias("row_count"))
        both = counted.withColumn("result", F.lit(name)).join(
            rows.withColumn("result", F.lit(name)), "result")
        parts.append(both.select(
            "result", "row_count", F.lit(len(df.columns)).alias("column_count"),
            F.lit(df.schema.simpleString()).alias("schema"), "first_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
