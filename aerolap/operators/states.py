"""Analyses kept up to date file by file.

Each analysis has mergeable states (sums, counts, extremes, bit sets) that add up in
any order. :func:`update` writes the states of every input file once, as a
partition of a store; a file that is new or has changed costs its own scan and
nothing else, and the states of a file that has gone or changed are dropped.
:func:`report` merges what is stored into the full result.

A file is known by its path, size and modification time. Partitions are staged,
verified and moved into place (``sources.publish``), so an update that fails
leaves each file's states old or new, and the next one finishes the work. A file
without rows has no states and is looked at again each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.operators import bands, ranking, routes
from aerolap.sources.publish import drop_folder, partitions, replace_partitions

#: Analysis -> (flights, extra keys) -> states, and states -> result.
ANALYSES: dict[str, tuple[Callable[[DataFrame, Sequence[str]], DataFrame],
                          Callable[[DataFrame], DataFrame]]] = {
    "route_stats": (routes.route_states, routes.route_stats_of),
    "band_report": (bands.band_states, bands.band_report_of),
    "carrier_ranking": (ranking.ranking_states, ranking.carrier_ranking_of),
}
FILE = "state_of"


def file_version() -> Column:
    """Identity of the file that a row comes from."""
    m = F.col("_metadata")
    return F.sha1(F.concat_ws("|", m["file_path"], m["file_size"].cast("string"),
                              F.unix_micros(m["file_modification_time"]).cast("string")))


def versions(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Version -> file, for the Parquet files under the paths; reads no data."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", True).load(list(paths))
    return {r.version: r.path for r in files.select("path", file_version().alias("version")).collect()}


def update(spark: SparkSession, paths: Sequence[str], store: str, analysis: str) -> tuple[int, int]:
    """Bring the stored states up to date with the cleaned flight files under ``paths``.

    Returns how many files were read and how many states were dropped.
    """
    states, _ = ANALYSES[analysis]
    root = f"{store.rstrip('/')}/{analysis}"
    now = versions(spark, paths)
    have = {p.partition("=")[2] for p in partitions(spark, root, 1)}
    new = sorted(now[v] for v in now.keys() - have)
    if new:
        flights = spark.read.parquet(*new).withColumn(FILE, file_version())
        replace_partitions(states(flights, [FILE]), root, [FILE])
    gone = have - now.keys()
    for version in gone:
        drop_folder(spark, f"{root}/{FILE}={version}")
    return len(new), len(gone)


def report(spark: SparkSession, store: str, analysis: str) -> DataFrame:
    """The analysis over all files whose states are stored."""
    root = f"{store.rstrip('/')}/{analysis}"
    return ANALYSES[analysis][1](spark.read.parquet(root).drop(FILE))
