"""Overwrites that survive a failure.

``mode("overwrite")`` deletes the old files before the new ones are complete: a
job that dies in between leaves neither. Here rows are written to a folder of
their own beside the target, read back and counted, and only then moved into
place, old files first aside; with partitions only those that the new rows have are
replaced. The moves are renames of folders, one per partition. A failure while
writing or verifying leaves the target untouched; one between two renames leaves
the old partition beside the target, from where :func:`recover` puts it back.

Renames are atomic on HDFS and local file systems. On object stores a rename is a copy,
so there a reader may see a partition late, but never a mixture of both.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    a, fs = _fs(spark, source)
    b, _ = _fs(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def drop_folder(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _aside(target: str) -> str:
    """Where the old files of a target wait while the new ones take their place."""
    head, _, name = target.rstrip("/").rpartition("/")
    return f"{head}/.old-{name}"


def publish(spark: SparkSession, staged: str, target: str, empty: DataFrame | None = None) -> None:
    """Move a finished folder to its place; what was there goes once the new one stands.

    A staged folder that does not exist stands for no rows: ``empty`` is written in its place.
    """
    if not _exists(spark, staged):
        if empty is None:
            raise FileNotFoundError(staged)
        empty.write.parquet(staged)
    old = _aside(target)
    recover(spark, target)
    if _exists(spark, target):
        _rename(spark, target, old)
    try:
        _rename(spark, staged, target)
    except Exception:
        recover(spark, target)
        raise
    drop_folder(spark, old)


def recover(spark: SparkSession, target: str) -> None:
    """Undo or finish a move that was interrupted between its renames."""
    old = _aside(target)
    if _exists(spark, old):
        if _exists(spark, target):
            drop_folder(spark, old)
        else:
            _rename(spark, old, target)


def _staged(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """``df`` written beside ``path``, read back, and its rows counted against those written."""
    spark = df.sparkSession
    head, _, name = path.rstrip("/").rpartition("/")
    staged = f"{head}/.staged-{name}-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(*partition_by).parquet(staged)
        found = spark.read.schema(df.schema).parquet(staged).count()
        if found != seen.get["n"]:
            raise OSError(f"{staged} has {found} rows of {seen.get['n']}")
    except Exception:
        drop_folder(spark, staged)
        raise
    return staged


def replace(df: DataFrame, path: str) -> str:
    """The rows of ``df`` as Parquet at ``path`` in place of what is there."""
    staged = _staged(df, path, ())
    publish(df.sparkSession, staged, path)
    return path


def partitions(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Partition folders below ``root``, relative to it; none if it does not exist."""
    found = [""] if _exists(spark, root) else []
    for _ in range(depth):
        deeper = []
        for at in found:
            p, fs = _fs(spark, f"{root}/{at}" if at else root)
            for s in fs.listStatus(p):
                name = s.getPath().getName()
                if s.isDirectory() and "=" in name and not name.startswith((".", "_")):
                    deeper.append(f"{at}/{name}" if at else name)
        found = deeper
    return sorted(found)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> list[str]:
    """Replace the partitions that ``df`` has rows of; all others stay as they are.

    Returns the partitions replaced, as ``name=value`` paths.
    """
    spark = df.sparkSession
    staged = _staged(df, path, partition_by)
    done = partitions(spark, staged, len(partition_by))
    for part in done:
        publish(spark, f"{staged}/{part}", f"{path.rstrip('/')}/{part}")
    drop_folder(spark, staged)
    return done
