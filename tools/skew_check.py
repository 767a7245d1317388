"""Hot-key check: one airport holding a third of all rows.

Usage: python tools/skew_check.py [SF_DIR]

Builds two datasets of the same size from the cleaned table of SF_DIR:
``even`` (the table plus copies of all airports' rows) and ``hub`` (the
table plus copies of one airport's rows until it holds 1/3 of all rows),
runs the three analyses on both, and prints one JSON line with the median
times and, per analysis, the largest shuffle read of any reduce task
relative to the median task (from the event log). Partial aggregation
before the exchange keeps that ratio flat on the hub dataset.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from aerolap.operators import bands as B  # noqa: E402
from aerolap.operators import ranking as R  # noqa: E402
from aerolap.operators import routes as A  # noqa: E402
from aerolap.operators import scale as D  # noqa: E402
from aerolap.operators.clean import clean  # noqa: E402
from aerolap.session import local_session, scratch_path  # noqa: E402
from aerolap.sources import read_flights, write_parquet  # noqa: E402
from aerolap.sources.fixtures import load_raw_flights  # noqa: E402


def _events(log_dir: str) -> list[dict]:
    import zstandard

    out = []
    for fn in glob.glob(f"{log_dir}/*/events*") + glob.glob(f"{log_dir}/*"):
        if os.path.isdir(fn):
            continue
        raw = open(fn, "rb").read()
        if fn.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode(errors="ignore").splitlines():
            try:
                out.append(json.loads(line))
            except ValueError:
                pass
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="aerolap-skew-events-")
    spark = local_session("skew-check", cpus=8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"})
    f = read_flights(spark, write_parquet(clean(load_raw_flights(spark, sf_dir)),
                                          scratch_path(spark, "skew_base")))
    n = f.count()
    hub_code = f.groupBy("origin").count().orderBy("origin").first()["origin"]
    hub = f.filter(F.col("origin") == hub_code)
    h = hub.count()
    # k extra copies of the hub make it 1/3 of all rows: (h*(k+1)) = (n + h*k) / 3
    k = max(1, round((n - 3 * h) / (2 * h)))
    hub_ds = write_parquet(f.unionByName(D.replicate(hub, k)), scratch_path(spark, "skew_hub"))
    extra = f.sample(False, min(1.0, h * k / n), 7)
    even_ds = write_parquet(f.unionByName(extra), scratch_path(spark, "skew_even"))
    ops = {"route_stats": A.route_stats, "band_report": B.band_report,
           "carrier_ranking": R.carrier_ranking}
    result = {"rows_hub": spark.read.parquet(hub_ds).count(),
              "rows_even": spark.read.parquet(even_ds).count(),
              "hub_share": None, "times": {}, "max_over_median_shuffle_read": {}}
    hub_rows = spark.read.parquet(hub_ds).filter(F.col("origin") == hub_code).count()
    result["hub_share"] = round(hub_rows / result["rows_hub"], 3)
    for ds_name, path in [("even", even_ds), ("hub", hub_ds)]:
        data = read_flights(spark, path)
        for name, op in ops.items():
            for _ in range(2):
                write_parquet(op(data), scratch_path(spark, "skew_out"))
            samples = []
            for i in range(3):
                spark.sparkContext.setJobGroup(f"{ds_name}:{name}:{i}", "skew")
                t0 = time.perf_counter()
                write_parquet(op(data), scratch_path(spark, "skew_out"))
                samples.append(time.perf_counter() - t0)
            result["times"][f"{name}_{ds_name}"] = round(statistics.median(samples), 3)
    spark.stop()

    # largest / median shuffle read over the reduce tasks of each measured run
    job_group, stage_job = {}, {}
    reads = defaultdict(list)
    for e in _events(log_dir):
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            job_group[e["Job ID"]] = e.get("Properties", {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                stage_job[s] = e["Job ID"]
        elif ev == "SparkListenerTaskEnd":
            sr = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {})
            b = sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
            if b > 0:
                g = job_group.get(stage_job.get(e["Stage ID"]))
                if g:
                    reads[(g, e["Stage ID"])].append(b)
    worst = defaultdict(float)
    for (g, _), bs in reads.items():
        ds_name, name, _ = g.split(":")
        if len(bs) > 1:
            worst[f"{name}_{ds_name}"] = max(worst[f"{name}_{ds_name}"],
                                             max(bs) / max(1, statistics.median(bs)))
    result["max_over_median_shuffle_read"] = {k: round(v, 2) for k, v in sorted(worst.items())}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
