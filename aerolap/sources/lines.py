"""CSV records with their place in the file (Q20).

A file is read in splits, and a split does not know how many lines come before
it, nor whether it begins inside a quoted value that holds line ends. Both
follow from a few numbers per split, so the places are found in three steps:

1. each split is read once and gives one row: its lines, whether its quotes are
   odd in number, and how many records would begin in it if it begins outside
   (or inside) a quoted value;
2. prefix sums over the splits of a file, in order of their starts, tell where
   each split really begins;
3. a second read numbers the lines inside each split and adds the split's place.

A line is a record by itself unless its quotes are odd or it lies inside a
quoted value; only lines of such longer records are grouped, by file and
record. Fields are then parsed by Spark's own CSV parser. No step moves the
lines of a file to one task.

Lines end with ``\\n`` (a ``\\r`` before it belongs to the line end). Empty lines
outside quotes are lines but not records. The header is record 1, so a file's
first row is record 2. A quoted value that is never closed reaches to the end of
its file, as for any CSV reader.

A file that was written in pieces, as Spark writes one, is a folder of files that each
have the header. With ``folders`` their rows are numbered as in the one file that the pieces
make up in the order of their names, below the header of the first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from aerolap.schema import NA_TOKENS, RAW_SCHEMA
from aerolap.sources.files import files_by_header, materialise, text_columns, typed_columns

_SPLIT = "file string, start long, n_lines long, n_odd long, begins_outside long, begins_inside long"
_LINE = ("file string, start long, at long, inside boolean, odd boolean, filled boolean, "
         "before_outside long, before_inside long, value string")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, pa.RecordBatch]]:
    """Each batch cut where another split begins; tells whether the split is a new one."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0), batch.column(1).to_numpy()
        ids = file.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(start) != 0) | (np.diff(ids) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = (file[int(a)].as_py(), int(start[a]))
            yield *key, key != last, batch.slice(int(a), int(b - a))
            last = key


def _marks(values: pa.Array, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line: does it begin inside quotes, are its quotes odd, is it not empty?

    ``inside`` tells whether the first line does; a split's first line is taken
    to begin outside.
    """
    odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
    before = (np.cumsum(odd) - odd + inside) % 2
    empty = pc.or_(pc.equal(values, ""), pc.equal(values, "\r")).to_numpy(zero_copy_only=False)
    return before.astype(bool), odd.astype(bool), ~empty


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split."""
    rows: list[list] = []
    for file, start, new, part in _runs(batches):
        if new:
            rows.append([file, start, 0, 0, 0, 0])
        row = rows[-1]
        inside, odd, filled = _marks(part.column(2), row[3] % 2)
        row[2] += len(odd)
        row[3] += int(odd.sum())
        row[4] += int((filled & ~inside).sum())
        row[5] += int((filled & inside).sum())
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)],
                                         ["file", "start", "n_lines", "n_odd", "begins_outside",
                                          "begins_inside"])


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines with what their split knows of their place."""
    at = n_odd = outside = within = 0
    for _, _, new, part in _runs(batches):
        if new:
            at = n_odd = outside = within = 0
        inside, odd, filled = _marks(part.column(2), n_odd % 2)
        first, second = (filled & ~inside).astype(np.int64), (filled & inside).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(np.arange(at, at + len(odd))),
             pa.array(inside), pa.array(odd), pa.array(filled),
             pa.array(outside + np.cumsum(first) - first), pa.array(within + np.cumsum(second) - second),
             part.column(2)],
            ["file", "start", "at", "inside", "odd", "filled", "before_outside", "before_inside", "value"])
        at, n_odd = at + len(odd), n_odd + int(odd.sum())
        outside, within = outside + int(first.sum()), within + int(second.sum())


def records(spark: SparkSession, files: Sequence[str], folders: bool = False) -> DataFrame:
    """(source_file, source_line, source_record, text) of every record of the files.

    ``source_line`` is the line that the record begins on. With ``folders`` the files of a
    folder count as one, and only the first one's header is a record. Counts the lines when
    called (one read of the files), numbers them when used.
    """
    lines = spark.read.option("lineSep", "\n").text(list(files)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        "value")
    splits = materialise(lines.mapInArrow(_count, _SPLIT), "csv_splits")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    places = splits.withColumn(
        "opens_inside", F.coalesce(F.sum("n_odd").over(earlier), F.lit(0)) % 2 == 1)
    begins = F.when(F.col("opens_inside"), F.col("begins_inside")).otherwise(F.col("begins_outside"))
    places = places.withColumn("begins", begins).withColumns({
        "line0": F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)),
        "record0": F.coalesce(F.sum("begins").over(earlier), F.lit(0)), "header": F.lit(0)})
    if folders:
        # a piece begins where the ones before it end, its own header left out
        pieces = places.groupBy("file").agg(F.sum("n_lines").alias("n"), F.sum("begins").alias("m"))
        ahead = Window.partitionBy(F.regexp_replace("file", "[^/]*$", "")).orderBy("file").rowsBetween(
            Window.unboundedPreceding, -1)
        pieces = pieces.select("file", F.sum(F.col("n") - 1).over(ahead).alias("n"),
                               F.sum(F.col("m") - 1).over(ahead).alias("m"))
        places = places.join(pieces, "file").withColumns({
            "line0": F.col("line0") + F.coalesce("n", F.lit(0)),
            "record0": F.col("record0") + F.coalesce("m", F.lit(0)),
            "header": F.when(F.col("m").isNotNull(), F.col("m") + 1).otherwise(F.lit(0))})
    places = places.select("file", "start", "opens_inside", "line0", "record0", "header")
    inside = F.col("inside") != F.col("opens_inside")
    before = F.when(F.col("opens_inside"), F.col("before_inside")).otherwise(F.col("before_outside"))
    placed = (
        lines.mapInArrow(_number, _LINE).join(places, ["file", "start"])
        .withColumn("inside", inside).where("inside OR filled")
        .select("file", (F.col("line0") + F.col("at") + 1).alias("line"),
                (F.col("record0") + before + F.when(F.col("inside"), 0).otherwise(1)).alias("record"),
                (F.col("inside") | F.col("odd")).alias("longer"), "value", "header"))
    if folders:
        placed = placed.where("record > header")
    placed = placed.drop("header")
    if splits.where("n_odd > 0").isEmpty():
        whole = placed
    else:
        parts = placed.where("longer").groupBy("file", "record").agg(
            F.min("line").alias("line"),
            F.array_sort(F.collect_list(F.struct("line", "value")))["value"].alias("values"))
        whole = placed.where("NOT longer").select("file", "line", "record", "value").unionByName(
            parts.select("file", "line", "record", F.array_join("values", "\n").alias("value")))
    return whole.select(F.col("file").alias("source_file"), F.col("line").alias("source_line"),
                        F.col("record").alias("source_record"),
                        F.regexp_replace("value", "\r$", "").alias("text"))


def read_raw_csv_lines(spark: SparkSession, path: str | Sequence[str],
                       schema: T.StructType = RAW_SCHEMA,
                       na_tokens: Sequence[str] = NA_TOKENS, folders: bool = False) -> DataFrame:
    """``read_raw_csv`` with ``source_file``, ``source_line`` and ``source_record`` of each row.

    Values are those of ``read_raw_csv``; values that hold line ends are read whole. With
    ``folders`` the files of a folder, all with the same header, are numbered as one.
    """
    parts = []
    for header, files in files_by_header(spark, path).items():
        rows = records(spark, files, folders).where("source_record > 1")
        fields = F.from_csv("text", text_columns(header).simpleString()[7:-1].replace(":", " "),
                            {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
        # a record is parsed once, below the generator, however often its cells are looked at
        text = rows.select(F.inline(F.array(fields)), "source_file", "source_line", "source_record")
        parts.append(text.select(*typed_columns(header, schema, na_tokens, files[0]),
                                 "source_file", "source_line", "source_record"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
