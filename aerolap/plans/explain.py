"""Reading a physical plan: scans, their read schema and pushed filters.

Used by the tests to pin the plan properties the operators are designed
for (one scan per analysis, pruned columns, pushed filters, no Python
nodes, group limits before shuffles).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The physical plan as text (the initial plan under AQE)."""
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(df: DataFrame) -> list[list[str]]:
    """Column names read by each file scan, in plan order."""
    out = []
    for m in re.finditer(r"FileScan \w+ \[([^\]]*)\]", physical_plan(df)):
        out.append([c.split("#")[0] for c in m.group(1).split(",") if c])
    return out


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` list of each file scan, as text."""
    # the text may be abbreviated with "..." before the closing bracket
    return re.findall(r"PushedFilters: \[(.*?)(?:\]|\.\.\.)", physical_plan(df))


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of a physical operator name (e.g. ``Exchange``)."""
    return len(re.findall(rf"\b{re.escape(name)}\b", physical_plan(df)))


def python_nodes(df: DataFrame) -> int:
    """Python evaluation nodes (row or Arrow UDFs) in the plan."""
    plan = physical_plan(df)
    return sum(plan.count(n) for n in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                       "MapInPandas", "PythonUDF"))
