"""Write PLANS.md: the physical plans of the main operators, with notes.

Usage: python tools/plan_report.py [SF_DIR] > PLANS.md

Analyses run on the written cleaned Parquet and checks on the raw Parquet,
as in a deployment; each plan is the optimised physical plan before AQE
re-planning, reduced to the operator tree plus, per scan, the columns read
and the filters pushed into Parquet.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerolap.operators import bands as B  # noqa: E402
from aerolap.operators import quality as Q  # noqa: E402
from aerolap.operators import ranking as R  # noqa: E402
from aerolap.operators import routes as A  # noqa: E402
from aerolap.operators import scale as D  # noqa: E402
from aerolap.operators import timechecks as TC  # noqa: E402
from aerolap.operators import views as V  # noqa: E402
from aerolap.operators.clean import clean  # noqa: E402
from aerolap.plans.explain import physical_plan  # noqa: E402
from aerolap.schema import RAW_COLUMNS  # noqa: E402
from aerolap.session import local_session, scratch_path  # noqa: E402
from aerolap.sources import read_flights, write_parquet  # noqa: E402
from aerolap.sources.fixtures import load_raw_flights  # noqa: E402

NOTES = {
    "route_stats": "One scan of 6 columns. Level 1 is a codegen'd partial/final HashAggregate "
                   "by (carrier, route, month); level 2 folds at most 12 rows per route, so "
                   "its object aggregate (collect_list) only sees aggregated rows. The last "
                   "exchange is the range partitioning of the ordered result.",
    "band_report": "One scan of 11 columns with the band filter pushed into Parquet; one "
                   "partial/final aggregation carries the counts, both means and nine cause "
                   "counters; the top-3 list is a projection over the aggregated rows.",
    "band_report_joined": "The join form: the groups' statistics joined to their causes, both "
                          "read from the one written aggregate of the flights.",
    "carrier_ranking": "One scan of 5 columns with IsNotNull(origin) pushed; partial/final "
                       "aggregation by (airport, carrier); one exchange by airport of the "
                       "aggregated rows; the airport mean and the rank share one Window.",
    "carrier_ranking_joined": "The join form: the written sums per (airport, carrier), joined "
                              "to their own totals per airport.",
    "validation_report": "One scan of the 14 columns the checks read; flags are computed in "
                         "a projection and counted by one global aggregation.",
    "bad_rows": "The any-error flag is computed once in a projection and read through a "
                "one-row generator, so the filter does not re-inline the seven checks.",
    "error_examples": "Errors stacked to long form by a generator; ranked within hash buckets "
                      "of a field first (a group limit before the exchange), then within the "
                      "field; joined to the errors per field.",
    "null_report": "One aggregation with one counter per column, then an inline to rows.",
    "replicate_4": "One scan and a Generate; no union, no join.",
    "top_routes": "The first three carriers are a bounded top-N (TakeOrderedAndProject), joined "
                  "back null-safe; the per-carrier limit is a window.",
}


def tree(plan: str) -> list[str]:
    lines = []
    for line in plan.splitlines():
        m = re.match(r"^([ :+\-*|]*)(\*?\(?\d*\)? ?)?([A-Za-z]+)", line)
        if not m:
            continue
        lead = line[: len(line) - len(line.lstrip(" :+-|"))]
        name = re.match(r"[*()0-9 ]*([A-Za-z]+)", line[len(lead):])
        if name:
            lines.append(lead + name.group(1))
    return lines


def scans(plan: str) -> list[str]:
    out = []
    for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[(.*?)\](?:, |$)",
                         plan, flags=re.S):
        cols = [c.split("#")[0] for c in m.group(2).split(",") if c]
        out.append(f"{m.group(1)} scan, {len(cols)} columns: {', '.join(cols)}; "
                   f"pushed: [{m.group(3)}]")
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("plan-report", cpus=8,
                          extra={"spark.sql.maxMetadataStringLength": "100000",
                                 "spark.sql.debug.maxToStringFields": "1000"})
    raw = load_raw_flights(spark, sf_dir)
    f = read_flights(spark, write_parquet(clean(raw), scratch_path(spark, "plan_report")))
    plans = {
        "route_stats": A.route_stats(f),
        "band_report": B.band_report(f),
        "band_report_joined": B.band_report_joined(f),
        "carrier_ranking": R.carrier_ranking(f),
        "carrier_ranking_joined": R.carrier_ranking_joined(f),
        "validation_report": TC.validation_report(raw),
        "bad_rows": TC.bad_rows(raw),
        "error_examples": TC.error_examples(raw),
        "null_report": Q.null_report(raw.select(*RAW_COLUMNS)),
        "replicate_4": D.replicate(f, 4),
        "top_routes": V.top_routes(A.route_stats(f, ordered=False)),
    }
    print("# Physical plans of the main operators\n")
    print("Generated by `python tools/plan_report.py` on the sf0.01 test data; "
          "analyses read the written cleaned Parquet, checks the raw Parquet.\n")
    for name, df in plans.items():
        plan = physical_plan(df)
        print(f"## {name}\n\n{NOTES.get(name, '')}\n")
        for s in scans(plan):
            print(f"- {s}")
        print("\n```\n" + "\n".join(tree(plan)) + "\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
