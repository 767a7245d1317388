"""Types of CSV columns, inferred from all rows.

Each cell belongs to one kind: missing, whole number of 32 or 64 bits, other
number, date, or text. A column's state is the set of the kinds of its cells, as
bits; one aggregation folds the states of all columns, and states of files are
merged by OR, in any order, so a state may be kept per file and a new file costs only
its own read. The state's upper bound in the lattice of types is the column's
type: numbers widen (integer, long, double), a date stays a date only alone, and
everything else is text. A column without a value is text.

Unlike a sample of rows, all rows decide, so no later row can contradict the type.
Batches of rows are first reduced to the distinct cells of each column; of these, short
whole numbers, plain decimals and texts that begin with a letter are told by patterns over
the batch, and :func:`kind` decides the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.functions._util import text_number
from aerolap.schema import NA_TOKENS
from aerolap.sources.files import files_by_header, read_raw_csv, text_columns

INTEGER, LONG, DOUBLE, DATE, TEXT = 1, 2, 4, 8, 16


def kind(cell: Column, na_tokens: Sequence[str] = NA_TOKENS) -> Column:
    """The bit of a text cell's kind; 0 for a missing one."""
    whole = cell.rlike(r"^\s*[+-]?\d+\s*$")
    day = cell.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return (
        F.when(cell.isNull() | cell.isin(list(na_tokens)), 0)
        .when(whole & cell.try_cast("int").isNotNull(), INTEGER)
        .when(whole & cell.try_cast("long").isNotNull(), LONG)
        .when(text_number(cell).isNotNull(), DOUBLE)
        .when(day & cell.try_cast("date").isNotNull(), DATE)
        .otherwise(TEXT))


#: Cells whose kind the pattern alone tells; each is one for :func:`kind`, too.
_OBVIOUS = {INTEGER: r"\A[+-]?[0-9]{1,9}\z", DOUBLE: r"\A[+-]?[0-9]{1,15}\.[0-9]{1,15}\z", TEXT: r"\A[A-Za-z]"}
_CELLS = "source_file string, at int, state int, cells array<string>"


def _reduced(width: int, na_tokens: Sequence[str]
             ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of cells -> per batch, file and column: bits of the obvious cells, the other cells once."""
    missing = pa.array(list(na_tokens), pa.string())

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file = batch.column(width)
            ids = file.dictionary_encode().indices.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1), batch.num_rows] if batch.num_rows else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                states, others = [], []
                for i in range(width):
                    left = pc.unique(batch.column(i).slice(int(a), int(b - a))).drop_null()
                    left = left.filter(pc.invert(pc.is_in(left, missing.cast(left.type))))
                    state = 0
                    for bit, pattern in _OBVIOUS.items():
                        if len(left):
                            hit = pc.match_substring_regex(left, pattern)
                            rest = left.filter(pc.invert(hit))
                            state |= bit if len(rest) < len(left) else 0
                            left = rest
                    states.append(state)
                    others.append(left.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file[int(a)].as_py()] * width), pa.array(range(width), pa.int32()),
                     pa.array(states, pa.int32()), pa.array(others, pa.list_(pa.string()))],
                    ["source_file", "at", "state", "cells"])
    return reduce


def upper_bound(state: int) -> T.DataType:
    """The type that holds every kind of the state."""
    if state == DATE:
        return T.DateType()
    if state == 0 or state & (DATE | TEXT):
        return T.StringType()
    return T.DoubleType() if state & DOUBLE else T.LongType() if state & LONG else T.IntegerType()


def column_states(spark: SparkSession, path: str | Sequence[str], na_tokens: Sequence[str] = NA_TOKENS
                  ) -> DataFrame:
    """The state of each column of each file: (source_file, column, state).

    One read per header, and an aggregation of what its batches leave; a row per file and column.
    """
    parts = []
    for header, files in files_by_header(spark, path).items():
        cells = spark.read.schema(text_columns(header)).option("header", True).option(
            "quote", '"').option("escape", '"').csv(files)
        reduced = cells.select("*", F.col("_metadata.file_path").alias("source_file")).mapInArrow(
            _reduced(len(header), na_tokens), _CELLS)
        bits = reduced.select("source_file", "at", "state", F.explode_outer("cells").alias("cell")).select(
            "source_file", "at", F.col("state").bitwiseOR(kind(F.col("cell"), na_tokens)).alias("state"))
        states = bits.groupBy("source_file", "at").agg(F.bit_or("state").alias("state"))
        names = F.array(*[F.lit(n) for n in header])
        parts.append(states.select("source_file", names[F.col("at")].alias("column"), "state"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_states(states: DataFrame) -> dict[str, int]:
    """States per column over all files; as many rows as there are columns reach the driver."""
    return {r.column: r.state for r in
            states.groupBy("column").agg(F.bit_or("state").alias("state")).collect()}


def schema_of(states: Mapping[str, int], order: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, upper_bound(states.get(n, 0))) for n in order])


def infer_csv_schema(spark: SparkSession, path: str | Sequence[str],
                     na_tokens: Sequence[str] = NA_TOKENS) -> T.StructType:
    """The columns of all files, in order of first appearance, with their inferred types."""
    order = list(dict.fromkeys(n for header in files_by_header(spark, path) for n in header))
    return schema_of(merge_states(column_states(spark, path, na_tokens)), order)


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str],
                      na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """CSV files with a header as one typed table; a file without a column gives nulls in it."""
    return read_raw_csv(spark, path, infer_csv_schema(spark, path, na_tokens), na_tokens,
                        missing_as_null=True)
