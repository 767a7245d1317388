"""Dataset scaling for load tests.

Sizes below 1 are samples without replacement of an exact number of rows, 1
is the table itself, above 1 are N copies (bag semantics). Copies come from
one scan and a ``Generate``: no N-way union re-reading the source, and no join.

A sample is the rows with the smallest hashes of their keys: which rows that
are depends neither on the layout nor on the order of rows. The hash of the
last row taken is found by histograms, refined in rounds of 15 bits
(:func:`thresholds`), without sorting the table.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolap.schema import DATASET_SIZES, SAMPLE_SEED
from aerolap.session import drop_scratch, open_writers, scratch_path
from aerolap.sources.files import write_parquet
from aerolap.sources.paths import dataset_path, size_label
from aerolap.sources.publish import drop_folder, publish

#: Of each file that a task has open beside others.
ROW_GROUP_BYTES = 32 << 20


def sample(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Bernoulli sample without replacement (size depends on partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _digits(seed: int, cols: Sequence[str], n: int) -> Column:
    """The first ``n`` hex digits of the MD5 of seed and columns, as a number."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, n), 16, 10).cast("long")


def keyed_sample(df: DataFrame, fraction: float, keys: Sequence[str],
                 seed: int = SAMPLE_SEED) -> DataFrame:
    """D1 without regard to the layout: rows whose hashed key falls below ``fraction``.

    The hash is the first 28 bits of the MD5 of seed and key, so the sample
    is the same on any cluster, in any order of rows, and in plain SQL.
    """
    return df.filter(_digits(seed, keys, 7) < int(fraction * 16 ** 7))


def wanted_rows(n: int, fraction: float) -> int:
    """Rows in a sample of ``fraction`` of ``n`` rows, half a row rounded up."""
    return math.floor(Decimal(n) * Decimal(str(fraction)) + Decimal("0.5"))


def thresholds(hashes: DataFrame, ranks: Iterable[int]) -> dict[int, tuple[int, int, int]]:
    """The hash of the row of each rank, from 1, by hash.

    ``hashes`` has one column, a hash of 60 bits. rank -> (hash, number of rows
    with this hash that belong to the first ``rank`` rows, number of rows with
    this hash). A round counts the rows by their next 15 bits, for those whose
    earlier bits are still wanted; a round returns at most 2 ** 15 counts per
    rank to the driver, whatever the number of rows.
    """
    (name,) = hashes.columns
    at = {r: (0, r, 0) for r in ranks}  # bits so far, rank inside them, rows with them
    for shift in (45, 30, 15, 0):
        prefixes = sorted({bits for bits, _, _ in at.values()})
        rows = hashes if shift == 45 else hashes.where(
            F.shiftright(name, shift + 15).isin(prefixes))
        counts: dict[int, list[tuple[int, int]]] = {}
        for r in rows.groupBy(F.shiftright(name, shift).alias("bits")).count().collect():
            counts.setdefault(r["bits"] >> 15, []).append((r["bits"], r["count"]))
        for rank, (bits, left, _) in at.items():
            for b, n in sorted(counts[bits]):
                if left <= n:
                    at[rank] = (b, left, n)
                    break
                left -= n
    return at


def _hash_column(df: DataFrame) -> str:
    name = "_hash"
    while name in df.columns:
        name += "_"
    return name


def _tied(df: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` rows of rows that share the hash of their keys: the smallest by all columns.

    Rows that agree in the hash of all columns are equal but for collisions; equal
    rows are counted, not ranked, so many copies of one row stay spread out.
    """
    h = _hash_column(df)
    hashed = df.withColumn(h, _digits(seed, df.columns, 15))
    last, take, _ = thresholds(hashed.select(h), [n])[n]
    count = f"{h}count"
    before = Window.orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, -1)
    same = hashed.where(F.col(h) == last).groupBy(*df.columns).agg(F.count(F.lit(1)).alias(count))
    left = F.lit(take) - F.coalesce(F.sum(count).over(before), F.lit(0))
    kept = same.withColumn(count, F.least(F.col(count), left)).where(F.col(count) > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col(count)))
    return hashed.where(F.col(h) < last).drop(h).unionByName(
        kept.withColumn(h, copies).select(*df.columns))


def exact_sample(df: DataFrame, fraction: float, keys: Sequence[str] | None = None,
                 seed: int = SAMPLE_SEED) -> DataFrame:
    """D1 with an exact number of rows: those with the smallest hashes of ``keys``.

    The hash is the first 60 bits of the MD5 of seed and keys (default: all
    columns). Of rows that tie at the last hash the smallest by a hash of all
    columns are taken; of equal rows any. Finds the last hash when called: hashes
    are written once, then counted in rounds.
    """
    return _exact(df, [fraction], keys, seed)[fraction]


def _exact(df: DataFrame, fractions: Sequence[float], keys: Sequence[str] | None, seed: int
           ) -> dict[float, DataFrame]:
    last = _last_hashes(df, fractions, keys, seed)
    h = _hash_column(df)
    hashed = df.withColumn(h, _digits(seed, keys or df.columns, 15))
    out = {}
    for f in fractions:
        if last[f] is None:
            out[f] = df.limit(0)
            continue
        bound, take, tied = last[f]
        rows = hashed.where(F.col(h) <= bound if take == tied else F.col(h) < bound).drop(h)
        if take < tied:
            rows = rows.unionByName(_tied(hashed.where(F.col(h) == bound).drop(h), take, seed))
        out[f] = rows
    return out


def _last_hashes(df: DataFrame, fractions: Sequence[float], keys: Sequence[str] | None, seed: int
                 ) -> dict[float, tuple[int, int, int] | None]:
    """Hash, rows taken and rows tied at the last row of each sample (None: no row)."""
    spark = df.sparkSession
    path = write_parquet(df.select(_digits(seed, keys or df.columns, 15).alias("hash")),
                         scratch_path(spark, "hashes"))
    hashes = spark.read.parquet(path)
    n = hashes.count()
    ranks = {f: wanted_rows(n, f) for f in fractions}
    found = thresholds(hashes, {r for r in ranks.values() if r})
    drop_scratch(spark, path)
    return {f: found[r] if r else None for f, r in ranks.items()}


def replicate(df: DataFrame, n: int) -> DataFrame:
    """D3: every row ``n`` times, in one pass."""
    if n <= 1:
        return df
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(n)))).alias("_copy")).drop(
        "_copy"
    )


def _whole(size: float) -> int:
    if size != int(size):
        raise ValueError(f"sizes above 1 are whole numbers of copies, not {size}")
    return int(size)


def scale(df: DataFrame, size: float, seed: int = SAMPLE_SEED,
          keys: Sequence[str] | None = None) -> DataFrame:
    """D1-D3 by size factor: < 1 exact sample, 1 identity (D2), a whole number N copies."""
    if size < 1:
        return exact_sample(df, size, keys, seed)
    return df if size == 1 else replicate(df, _whole(size))


def labelled(df: DataFrame, sizes: Sequence[float], label: str, keys: Sequence[str] | None = None,
             seed: int = SAMPLE_SEED) -> DataFrame:
    """Every row once for each dataset and copy that it belongs to, named in ``label``.

    One scan of ``df``, and a generator; only where a sample cuts through rows
    that tie in their hash are these read once more.
    """
    fractions = [s for s in sizes if s < 1]
    last = _last_hashes(df, fractions, keys, seed) if fractions else {}
    digits = _digits(seed, keys or df.columns, 15)
    parts, ties = [], []
    for s in sizes:
        name = F.lit(size_label(s))
        if s >= 1:
            parts.append(F.array_repeat(name, _whole(s)))
        elif last[s] is not None:
            bound, take, tied = last[s]
            inside = F.col("_digits") <= bound if take == tied else F.col("_digits") < bound
            parts.append(F.when(inside, F.array(name)).otherwise(F.array().cast("array<int>")))
            if take < tied:
                ties.append(_tied(df.where(digits == bound), take, seed).withColumn(label, name))
    if not parts:
        return df.limit(0).withColumn(label, F.lit(0))
    if fractions:
        # the hash is computed once per row, below the generator
        rows = df.select("*", F.inline(F.array(F.struct(digits.alias("_digits")))))
    else:
        rows = df.withColumn("_digits", F.lit(0))
    out = rows.select(*df.columns, F.explode(F.concat(*parts)).alias(label))
    for t in ties:
        out = out.unionByName(t)
    return out


def write_sizes(cleaned: DataFrame, base: str, sizes: Iterable[float] = DATASET_SIZES,
                seed: int = SAMPLE_SEED, keys: Sequence[str] | None = None) -> dict[float, str]:
    """Write the dataset of each size asked for under ``base``; size -> path.

    All sizes come from one scan: rows are labelled and written partitioned by
    the label beside the datasets, and each part is then moved to its place, so
    a write that fails leaves the old datasets. Sizes not asked for are not
    touched. With samples among the sizes the cleaned rows are written first, since
    their hashes are needed before: as the dataset of size 1 if that is asked for,
    else to scratch.
    """
    spark, sizes = cleaned.sparkSession, list(dict.fromkeys(sizes))
    rows, todo = cleaned, sizes
    label = f"size{_hash_column(cleaned)}"
    staged = f"{base.rstrip('/')}/.sizes-{uuid.uuid4().hex[:12]}"
    first = None
    if any(s < 1 for s in sizes):
        first = f"{staged}-1" if 1 in sizes else scratch_path(spark, "cleaned")
        cleaned.write.option("compression", "zstd").parquet(first)
        rows, todo = spark.read.schema(cleaned.schema).parquet(first), [s for s in sizes if s != 1]
    # a row's copies come together, so each size has its file open, and no row is sorted;
    # row groups are small, since a task holds one of each size
    with open_writers(spark, len(todo) + 1):
        labelled(rows, todo, label, keys, seed).write.partitionBy(label).options(
            **{"compression": "zstd", "parquet.block.size": ROW_GROUP_BYTES}).parquet(staged)
    out = {}
    for s in sizes:
        out[s] = dataset_path(base, s)
        part = f"{staged}/{label}={size_label(s)}" if s in todo else first
        publish(spark, part, out[s], empty=cleaned.limit(0))
    drop_folder(spark, staged)
    if first and 1 not in sizes:
        drop_scratch(spark, first)
    return out


def manifest(spark: SparkSession, paths: dict[float, str]) -> DataFrame:
    """Label and row count of each written dataset, one row per size."""
    parts = [
        spark.read.parquet(p).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(size_label(s)).alias("label"), "row_count"
        )
        for s, p in paths.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
