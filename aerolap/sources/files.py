"""File sources and sinks.

Readers declare their schema (no inference pass) and return lazy
DataFrames, so Catalyst pushes column pruning and filters into the scan.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.functions._util import cell_number
from aerolap.schema import NA_TOKENS, RAW_SCHEMA
from aerolap.session import scratch_path


def _data_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The data files under the paths (globs allowed), hidden ones left out."""
    sc = spark.sparkContext
    found: list[str] = []
    for path in paths:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        for status in fs.globStatus(p) or []:
            todo = [status]
            while todo:
                at = todo.pop()
                if at.getPath().getName().startswith(("_", ".")) and at is not status:
                    continue
                if at.isDirectory():
                    todo.extend(fs.listStatus(at.getPath()))
                elif at.getLen() > 0:
                    found.append(at.getPath().toString())
    if not found:
        raise FileNotFoundError(f"no data files at {', '.join(paths)}")
    return sorted(found)


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first line of a CSV file (reads that line only)."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(conf).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    return tuple(n.strip().lower() for n in next(csv.reader([line.lstrip("\ufeff")]), []))


def files_by_header(spark: SparkSession, path: str | Sequence[str]
                    ) -> dict[tuple[str, ...], list[str]]:
    """The data files under the paths, by the column names in their first line."""
    out: dict[tuple[str, ...], list[str]] = {}
    for file in _data_files(spark, [path] if isinstance(path, str) else list(path)):
        out.setdefault(_header(spark, file), []).append(file)
    return out


def text_columns(header: Sequence[str]) -> T.StructType:
    """All columns of a file with this header, as text, named by position."""
    return T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])


def typed_columns(header: Sequence[str], schema: T.StructType, na_tokens: Sequence[str],
                  file: str, missing_as_null: bool = False) -> list[Column]:
    """The columns of ``schema`` from the :func:`text_columns` of a file.

    A name that the header has not exactly once is an error; with
    ``missing_as_null`` a name that it lacks gives nulls.
    """
    wanted = [f.name.lower() for f in schema.fields]
    if missing := [n for n in wanted if header.count(n) != 1
                   and not (missing_as_null and n not in header)]:
        raise ValueError(f"not exactly one column {', '.join(missing)} in {file}")
    numeric = [t for t in na_tokens if re.search(r"\d", t)]
    out = []
    for f, name in zip(schema.fields, wanted, strict=True):
        if name not in header:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"c{header.index(name)}")
        if isinstance(f.dataType, T.NumericType):
            # other tokens are no numbers, so they give null anyway
            v = F.when(~c.isin(numeric), c) if numeric else c
            out.append(cell_number(v).try_cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(_text_cell(c, na_tokens).alias(f.name))
        else:
            out.append(F.when(~c.isin(list(na_tokens)), c).try_cast(f.dataType).alias(f.name))
    return out


def _text_cell(c: Column, na_tokens: Sequence[str]) -> Column:
    """The text, null for an NA token.

    A higher-order function keeps the projection out of whole-stage code: the cells of
    a wide file would make one method there that is too long for the JIT compiler, while
    a projection of its own is generated in short methods.
    """
    return F.get(F.transform(F.array(c), lambda x: F.when(~x.isin(list(na_tokens)), x)), F.lit(0))


def read_raw_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW_SCHEMA,
    na_tokens: Sequence[str] = NA_TOKENS,
    source_file: bool = False,
    missing_as_null: bool = False,
) -> DataFrame:
    """Raw flight CSV with a header -> typed DataFrame.

    Columns are found by their header names (any order, any case, extra ones
    ignored); files with different headers are mapped each, and a missing
    column is an error, or null with ``missing_as_null``. Quotes inside values are doubled, as usual. Every cell
    is read as text, an NA token becomes null, and the text is converted
    leniently: dirty values give null, ``1.0`` is the integer 1. With
    ``source_file`` a column of that name tells the file each row came from
    (provenance of bad rows; ``sources.lines`` gives their lines as well).
    """
    parts = []
    for header, files in files_by_header(spark, path).items():
        text = (
            spark.read.schema(text_columns(header))
            .option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').csv(files)
        )
        out = typed_columns(header, schema, na_tokens, files[0], missing_as_null)
        if source_file:
            out.append(F.col("_metadata.file_path").alias("source_file"))
        parts.append(text.select(*out))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def read_flights(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Cleaned flight Parquet (S3); with ``columns`` a pruned scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def with_source_rows(df: DataFrame) -> DataFrame:
    """Add ``source_file`` and ``source_row`` (row index within the file) to a
    Parquet scan: the distributed counterpart of a file line number."""
    return df.select("*", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.row_index").alias("source_row"))


def read_declared(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet read through a declared column subset, matched by name."""
    return spark.read.schema(schema).parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """Overwrite ``path`` with ``df`` as Parquet (S6); returns the path."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


#: Of a compressed CSV file, which one task reads: about as much text as a split of a plain one.
PACKED_ROWS = 500_000


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), packed: bool = False) -> str:
    """Overwrite ``path`` with ``df`` as CSV with a header.

    Standard quoting (a quote inside a value is doubled), so other readers
    agree; blanks inside values are kept (Spark's writer trims them by
    default). With ``packed`` the files are compressed (gzip) and have at most
    ``PACKED_ROWS`` rows each, since such a file is not split when it is read.
    """
    w = (
        df.write.mode("overwrite").partitionBy(*partition_by)
        .option("header", True)
        .option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if packed:
        # the default level takes three times as long for a tenth less
        w = w.options(**{"compression": "gzip", "zlib.compress.level": "FOUR", "maxRecordsPerFile": PACKED_ROWS})
    w.csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV report written by :func:`write_csv` with its declared schema."""
    return (spark.read.schema(schema).option("header", True)
            .option("quote", '"').option("escape", '"').csv(path))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    For results that several branches of a plan read: the input is scanned
    once, and a lost executor costs only its own tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
