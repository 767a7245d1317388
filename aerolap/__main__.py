"""Command-line jobs: ``python -m aerolap <command> [options]``
(or ``spark-submit aerolap/__main__.py <command> ...``).

Each command is one Spark job over a deployment layout rooted at
``--base`` (any Hadoop file-system URI):

  preprocess     raw CSV -> cleaned Parquet datasets of every size
  task_3_1       route statistics          -> results/task_3_1/task_3_1_<size>
  task_3_2       delay-band report         -> results/task_3_2/task_3_2_<size>
  task_3_3       carrier ranking           -> results/task_3_3/task_3_3_<size>
  check_null     null report of the raw CSV
  check_flags    cancelled / diverted profiles of the raw CSV
  check_months   out-of-range months and month distribution
  check_errors   time-consistency report, bad rows with their source file and line, examples
  inspect_3_1 / inspect_3_2 / inspect_3_3 / inspect_outputs
                 the inspection views of a written result

The session is the caller's (``getOrCreate``): master, memory and
scheduling come from ``spark-submit``. Checks and views are written whole,
as Parquet below ``<base>/checks`` and ``<base>/views``; what is printed is
a preview that names the full number of rows.
"""

from __future__ import annotations

import argparse
import contextlib
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from aerolap import sources as S
from aerolap.operators import bands as B
from aerolap.operators import compare as C
from aerolap.operators import quality as Q
from aerolap.operators import ranking as R
from aerolap.operators import routes as A
from aerolap.operators import scale as D
from aerolap.operators import timechecks as TC
from aerolap.operators import views as V
from aerolap.operators.clean import clean
from aerolap.schema import DATASET_SIZES, RAW_COLUMNS
from aerolap.session import drop_scratch, scratch_path, tuned_for_input

TASKS = {
    "task_3_1": A.route_stats,
    "task_3_2": B.band_report,
    "task_3_3": R.carrier_ranking,
}


def _size(text: str) -> float:
    """``100`` -> 1.0, ``25`` -> 0.25 (the reference's percent labels)."""
    return float(text) / 100.0


class _Output:
    """Writes results as complete Parquet files and prints a preview of each."""

    def __init__(self, spark: SparkSession, folder: str, quiet: bool, rows: int):
        self.spark, self.folder, self.quiet, self.rows = spark, folder, quiet, rows
        self.paths: dict[str, str] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        path = S.write_parquet(df, f"{self.folder}/{name}")
        self.paths[name] = path
        done = self.spark.read.parquet(path)
        if not self.quiet:
            n = done.count()
            print(f"{name}: {n} rows in {path}" + f", the first {self.rows}" * (n > self.rows))
            done.show(self.rows, truncate=False)
        return done


def _check(command: str, raw: DataFrame, emit: _Output) -> None:
    """The checks of the raw table, which is a typed Parquet copy of the CSV."""
    if command == "check_null":
        emit("null_report", Q.null_report(raw.select(*RAW_COLUMNS)))
    elif command == "check_flags":
        for flag in ("cancelled", "diverted"):
            emit(f"{flag}_values", Q.value_distribution(raw, flag))
            emit(f"{flag}_profile", Q.flag_profile(raw, flag))
            emit(f"{flag}_delays", Q.describe_subset(raw, flag, ["dep_delay", "arr_delay"]))
        emit("cancelled_sample", Q.sample_rows(
            raw, "cancelled", ["fl_date", "op_unique_carrier", "origin", "dest"],
            ["dep_delay", "arr_delay"]))
    elif command == "check_months":
        emit("rows", Q.row_count(raw))
        emit("bad_months", Q.bad_months(raw))
        emit("months", Q.month_distribution(raw))
    else:
        emit("split", Q.split_counts(raw))
        emit("report", TC.validation_report(raw))
        emit("bad_rows", TC.bad_rows(raw))
        emit("examples", TC.error_examples(raw))


def _inspect(command: str, read, args, emit: _Output) -> None:
    """The views of written results."""
    items = args.items.split(",") if args.items else None
    if command == "inspect_3_1":
        stats = read("task_3_1")
        emit("top_routes", V.top_routes(stats, carriers=items, n_carriers=args.first, n=args.top))
        emit("route_counts", V.route_counts(stats))
    elif command == "inspect_3_2":
        emit("bands", V.band_view(read("task_3_2"), airports=items, n_airports=args.first,
                                  n_months=args.months))
    elif command == "inspect_3_3":
        ranking = read("task_3_3")
        emit("summary", V.ranking_summary(ranking))
        emit("ranking", V.ranking_view(ranking, airports=items, n_airports=args.first, n=args.top))
    else:
        results = {t: read(t) for t in TASKS}
        emit("profile", V.profile(results))
        emit("overview", C.overview(results, args.preview))


CHECKS = ("check_null", "check_flags", "check_months", "check_errors")
INSPECTIONS = ("inspect_3_1", "inspect_3_2", "inspect_3_3", "inspect_outputs")


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="aerolap")
    p.add_argument("command", choices=["preprocess", *TASKS, *CHECKS, *INSPECTIONS])
    p.add_argument("--base", required=True, help="deployment root URI")
    p.add_argument("-s", "--size", default="100", help="dataset size label in percent")
    p.add_argument("--raw", help="raw CSV path (default: <base>/data/raw/...)")
    p.add_argument("--sizes", default=",".join(str(int(s * 100)) for s in DATASET_SIZES))
    p.add_argument("--items", default=None, help="comma list of carriers / airports to inspect")
    p.add_argument("--first", type=int, default=3, help="without --items: so many carriers / airports")
    p.add_argument("--top", type=int, default=10, help="routes / carriers shown of each")
    p.add_argument("--months", type=int, default=3, help="months shown of each airport")
    p.add_argument("--preview", type=int, default=20, help="rows printed of each written result")
    p.add_argument("--quiet", action="store_true", help="do not print results")
    p.add_argument("--tune", action="store_true",
                   help="size scan splits and shuffle partitions from the input while the job runs")
    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"aerolap_{args.command}").getOrCreate()
    lay, base = S.Layout(args.base), args.base.rstrip("/")
    size = _size(args.size)
    out: dict = {"command": args.command}
    t0 = time.perf_counter()
    raw_path = args.raw or lay.raw_csv()
    source = lay.dataset(size) if args.command in TASKS else raw_path
    tuned = args.tune and args.command not in INSPECTIONS
    with tuned_for_input(spark, source) if tuned else contextlib.nullcontext({}) as settings:
        out["settings"] = settings
        if args.command == "preprocess":
            sizes = [_size(x) for x in args.sizes.split(",")]
            out["paths"] = D.write_sizes(clean(S.read_raw_csv(spark, raw_path)),
                                         f"{base}/data/processed", sizes)
        elif args.command in TASKS:
            result = TASKS[args.command](S.read_flights(spark, lay.dataset(size)))
            out["path"] = S.replace(result, lay.result(args.command, size))
        elif args.command in CHECKS:
            emit = _Output(spark, f"{base}/checks/{args.command}", args.quiet, args.preview)
            # the CSV is parsed once; what follows reads the typed copy
            read = S.read_raw_csv_lines if args.command == "check_errors" else S.read_raw_csv
            typed = S.write_parquet(read(spark, raw_path), scratch_path(spark, "typed_raw"))
            _check(args.command, spark.read.parquet(typed), emit)
            drop_scratch(spark, typed)
            out["paths"] = emit.paths
        else:
            emit = _Output(spark, f"{base}/views/{args.command}_{args.size}", args.quiet,
                           args.preview)
            _inspect(args.command, lambda t: S.read_flights(spark, lay.result(t, size)), args, emit)
            out["paths"] = emit.paths
    out["seconds"] = round(time.perf_counter() - t0, 3)
    if not args.quiet:
        print(f"{args.command}: {out['seconds']} s")
    return out


if __name__ == "__main__":
    run(sys.argv[1:])
