"""Shared pieces of the training-data operators."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from aerolap.session import drop_scratch, scratch_path

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task turns into Python objects together.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared scratch folder and reread, and its path.

    Cuts lineage: what follows reads files, so a lost executor repeats only
    its own tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        drop_scratch(spark, p)


def release() -> None:
    """Give memory that a task no longer uses back to the system.

    Python workers outlive their tasks, and an executor's limit counts them all.
    """
    gc.collect()
    trim()


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task function, followed by :func:`release` when its partition ends."""
    @functools.wraps(run)
    def then_release(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return then_release


def word_count(text: Column) -> Column:
    """Words of the text as a long, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of neighbouring texts of together about ``limit`` bytes, which
    bounds what a task holds at once; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield start, i - start
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes) - start


def text_column(fn: Callable, returns: T.DataType, arrow: pa.DataType) -> Callable[[Column], Column]:
    """A column function that applies ``fn(list of texts) -> list`` slice by slice."""
    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pa.array(fn(texts.slice(at, n).to_pylist()), arrow)
                     for at, n in text_slices(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], arrow)
        release()

    return run


def running_sums(df: DataFrame, group: list[str], block: str, order: list, value: str,
                 out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the group's earlier rows.

    A distributed prefix sum: the rows of a group lie in blocks that are
    ranges of the order, so a task sorts one block, and a second window runs
    over one row per block. The block sums are aggregated before they move.
    """
    keys = [*group, block]
    sums = df.groupBy(*keys).agg(F.sum(value).alias("_block_sum"))
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("_block_sum").over(before), F.lit(0))
                          .alias("_offset"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    rows = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = None
    for k in keys:
        c = rows[k].eqNullSafe(offsets[k])
        same = c if same is None else same & c
    return (rows.join(offsets, same)
            .select(*[rows[c] for c in df.columns],
                    (rows["_inside"] + offsets["_offset"]).alias(out)))
