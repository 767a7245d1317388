"""The command-line jobs end to end on a raw CSV written from the fixture."""

from __future__ import annotations

import pytest

from aerolap import sources as S
from aerolap.__main__ import run
from aerolap.operators import bands as B
from aerolap.operators import ranking as R
from aerolap.operators import routes as A
from aerolap.operators.clean import clean
from aerolap.schema import RAW_COLUMNS
from aerolap.session import scratch_path
from aerolap.sources.fixtures import load_raw_flights
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark):
    base = scratch_path(spark, "t_jobs")
    lay = S.Layout(base)
    raw = load_raw_flights(spark, SF_SMALL).select(*RAW_COLUMNS)
    S.write_csv(raw, lay.raw_csv())

    out = run(["preprocess", "--base", base, "--sizes", "50,100,200", "--quiet"], spark)
    assert set(out["paths"]) == {0.5, 1, 2}
    assert spark.read.parquet(lay.dataset(2)).count() == 12000

    cleaned = clean(S.read_raw_csv(spark, lay.raw_csv()))
    for task, op in [("task_3_1", A.route_stats), ("task_3_2", B.band_report),
                     ("task_3_3", R.carrier_ranking)]:
        res = run([task, "--base", base, "-s", "100", "--quiet"], spark)
        got = spark.read.parquet(res["path"])
        want = op(cleaned, ordered=False)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    rep = run(["check_null", "--base", base, "--quiet"], spark)
    assert spark.read.parquet(rep["paths"]["null_report"]).count() == 35
    bad = run(["check_errors", "--base", base, "--quiet"], spark)
    rows = spark.read.parquet(bad["paths"]["bad_rows"])
    assert rows.count() == 101 and rows.where("source_file LIKE '%.csv'").count() == 101
    assert spark.read.parquet(bad["paths"]["examples"]).count() == 20
    for cmd in ["check_flags", "check_months", "inspect_3_1", "inspect_3_2", "inspect_3_3",
                "inspect_outputs"]:
        assert run([cmd, "--base", base, "--quiet"], spark)["command"] == cmd


def test_cluster_settings():
    from aerolap.session import cluster_settings

    tb = 1024 ** 4
    big = cluster_settings(100 * tb, 8000)
    assert big["spark.sql.shuffle.partitions"] == "409600"     # 100 TB / 256 MB
    assert big["spark.sql.adaptive.enabled"] == "true"
    small = cluster_settings(20 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"       # two waves of cores


def test_tuning_is_undone(spark):
    import os

    from aerolap.session import input_bytes, tuned_for_input

    path = f"{SF_SMALL}/lineitem.parquet"
    assert input_bytes(spark, path) == os.path.getsize(path)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with tuned_for_input(spark, path) as settings:
        assert spark.conf.get(key) == settings[key]
    assert spark.conf.get(key) == before
    with pytest.raises(Exception):
        input_bytes(spark, f"{SF_SMALL}/no_such_table.parquet")


def test_views_are_written_whole(spark):
    base = scratch_path(spark, "t_views")
    lay = S.Layout(base)
    S.write_parquet(A.route_stats(clean(load_raw_flights(spark, SF_SMALL))),
                    lay.result("task_3_1", 1))
    out = run(["inspect_3_1", "--base", base, "--quiet", "--first", "11", "--top", "10"], spark)
    assert spark.read.parquet(out["paths"]["top_routes"]).count() == 110
