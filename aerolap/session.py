"""Session helpers: shared scratch folder and a local session for tests/bench.

Materialised intermediates and write/read round trips go to the shared
folder named by ``spark.checkpoint.dir`` (on a cluster: HDFS / object
store). Only when a session has none, as in local tests, is a local one set.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_SUBDIR = "aerolap"


def checkpoint_base(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    ``spark.checkpoint.dir`` (or the context's checkpoint folder) names it.
    Only a session on a ``local`` master may go without: it gets a temporary
    folder. On a cluster a machine-local folder would lose rows, so a missing
    setting is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerolap-ckpt-"))
        # Spark adds a per-application folder; use that from the first call on
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def _hadoop_path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one materialisation.

    The application owns the folder: it is removed when the driver ends, or
    earlier through :func:`drop_scratch`.
    """
    own = f"{checkpoint_base(spark)}/{_SUBDIR}/{spark.sparkContext.applicationId}"
    p, fs = _hadoop_path(spark, own)
    if not fs.exists(p):
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{own}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one scratch folder that nothing reads any more."""
    if f"/{_SUBDIR}/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def local_session(app: str = "aerolap", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the caller owns real sessions)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture for error messages costs several JVM round trips
        # per Column function; off for batch runs
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("AEROLAP_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="aerolap-wh-"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, total_cores: int,
                     partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Runtime SQL settings for a job over ``input_bytes`` on ``total_cores``.

    Scan splits of ``partition_bytes`` (the raw rows are wide); enough
    initial shuffle partitions that the largest exchange (the N-fold copies
    or a join moving about the input size) gives tasks of that size, and at
    least two waves of cores. AQE coalesces the small exchanges, which is
    every aggregation here: they shuffle partial aggregates only.
    """
    wanted = -(-int(input_bytes) // partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(max(2 * total_cores, wanted)),
    }


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files under ``path`` (file-system metadata, no scan)."""
    p, fs = _hadoop_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


@contextlib.contextmanager
def open_writers(spark: SparkSession, n: int):
    """Partitioned writes keep fewer than ``n`` files open per task instead of sorting the rows first.

    With the ``n``-th file of a task open, Spark sorts the rest of its rows.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """A job's shuffle files go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextlib.contextmanager
def tuned_for_input(spark: SparkSession, path: str):
    """The session with :func:`cluster_settings` for the data at ``path``.

    The caller's own settings are back when the block ends.
    """
    settings = cluster_settings(input_bytes(spark, path), spark.sparkContext.defaultParallelism)
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield settings
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
