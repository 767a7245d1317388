"""Comparison of results, exact samples and all sizes from one scan."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from aerolap.operators import compare as C
from aerolap.operators import routes as A
from aerolap.operators import scale as D
from aerolap.session import scratch_path
from tests.conftest import make_flights


def _df(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, x double, l array<int>")


ROWS = [("a", 1, 1.0, [1]), ("a", 1, 1.0, [1]), ("b", None, None, None), (None, 3, float("nan"), []),
        ("c", 4, 2.5, [1, 2])]


def test_digest_sees_rows_and_not_their_order(spark):
    a = _df(spark, ROWS)
    assert C.same_rows(a, _df(spark, ROWS[::-1]).repartition(3).select("x", "k", "l", "n"))
    assert not C.same_rows(a, _df(spark, ROWS[1:]))
    assert not C.same_rows(a, _df(spark, [*ROWS[1:], ROWS[2]]))
    assert not C.same_rows(a, _df(spark, [*ROWS[:2], ("b", None, 0.0, None), *ROWS[3:]]))
    assert not C.same_rows(a, a.drop("n"))
    one, two = C.digest(a).first(), C.digest(a.withColumn("n", F.col("n") + 1)).first()
    assert {c for c in a.columns if one.column_digests[c] != two.column_digests[c]} == {"n"}
    assert C.digest(a.limit(0)).first().row_count == 0


def test_diff_names_every_difference(spark):
    a = _df(spark, ROWS)
    assert C.diff(a, _df(spark, ROWS[::-1]), ["k"]).count() == 0
    b = _df(spark, [ROWS[0], ("b", 7, None, None), (None, 3, float("nan"), []), ("c", 4, 2.5000001, [2]),
                    ("d", 1, 1.0, [1])])
    got = {(r.k, r.occurrence, r.kind, r.column, r.left, r.right) for r in C.diff(a, b, ["k"], 1e-3).collect()}
    assert got == {("a", 2, "only_left", None, None, None), ("b", 1, "value", "n", None, "7"),
                   ("c", 1, "value", "l", "[1, 2]", "[2]"), ("d", 1, "only_right", None, None, None)}
    exact = C.diff(a, b, ["k"], {"n": 10.0})
    assert {r.column for r in exact.collect() if r.k == "c"} == {"x", "l"}
    summary = {(r.kind, r.column): r.differences for r in C.diff_summary(exact).collect()}
    assert summary[("value", "n")] == 1 and summary[("only_left", None)] == 1
    with pytest.raises(ValueError):
        C.diff(a, a.drop("n"), ["k"])


def test_overview(spark):
    a = _df(spark, ROWS)
    r = C.overview({"a": a, "none": a.limit(0)}, n=2).collect()
    assert [(x.result, x.row_count, x.column_count) for x in r] == [("a", 5, 4), ("none", 0, 4)]
    assert r[0].schema == a.schema.simpleString() and len(r[0].first_rows) == 2 and not r[1].first_rows
    assert r[0].first_rows[0].startswith('{"n":3')


def test_thresholds_equal_a_sort(spark):
    rng = random.Random(1)
    values = [rng.choice([0, 5, 2 ** 60 - 1, rng.getrandbits(60), rng.getrandbits(20)]) for _ in range(700)]
    df = spark.createDataFrame([(v,) for v in values], "h long")
    ranks = [1, 2, 200, 350, 699, 700]
    order = sorted(values)
    want = {r: (order[r - 1], r - sum(v < order[r - 1] for v in values), values.count(order[r - 1]))
            for r in ranks}
    assert D.thresholds(df, ranks) == want


def test_exact_sample_whatever_the_layout(spark):
    rng = random.Random(2)
    rows = [(rng.choice("abc"), i % 50, float(i % 7), None) for i in range(500)]
    rows += [("same", 1, 1.0, None)] * 300
    for keys in (None, ["k"], ["k", "n"]):
        for fraction in (0.1, 0.37, 0.9):
            taken = [sorted(map(str, D.exact_sample(_df(spark, rs).repartition(p), fraction, keys).collect()))
                     for rs, p in ((rows, 2), (rows[::-1], 7))]
            assert taken[0] == taken[1] and len(taken[0]) == D.wanted_rows(800, fraction)
            left = list(map(str, _df(spark, rows).collect()))
            for r in taken[0]:
                left.remove(r)
    assert D.exact_sample(_df(spark, []), 0.5).count() == 0
    assert D.exact_sample(_df(spark, rows), 0.0).count() == 0
    assert [D.wanted_rows(n, f) for n, f in ((10, .25), (2, .25), (1, .5), (3, .1))] == [3, 1, 1, 0]


def test_all_sizes_from_one_scan(spark):
    rows = [{"origin": f"A{i % 9}", "month": i % 12, "dep_delay": float(i % 4)} for i in range(200)]
    f = make_flights(spark, rows)
    base = scratch_path(spark, "t_sizes")
    sizes = [0.25, 0.5, 1, 2, 4]
    paths = D.write_sizes(f, base, sizes)
    read = {s: spark.read.parquet(p) for s, p in paths.items()}
    assert [read[s].count() for s in sizes] == [50, 100, 200, 400, 800]
    assert read[4].columns == f.columns
    assert read[0.25].exceptAll(read[0.5]).count() == 0 and read[0.5].exceptAll(f).count() == 0
    assert read[2].exceptAll(f.union(f)).count() == 0
    assert D.write_sizes(f.limit(0), scratch_path(spark, "t_none"), [0.5, 1]).keys() == {0.5, 1}
    src = scratch_path(spark, "t_src")
    make_flights(spark, [{**r, "distance": float(i)} for i, r in enumerate(rows)]).write.parquet(src)
    plan = D.labelled(spark.read.parquet(src), [0.25, 0.5, 1, 4], "_size")
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_each_size_of_a_task_has_its_file_open(spark, monkeypatch):
    asked, real = [], D.open_writers
    monkeypatch.setattr(D, "open_writers", lambda spark, n: (asked.append(n), real(spark, n))[1])
    written, scratch = [], D.scratch_path
    monkeypatch.setattr(D, "scratch_path", lambda spark, name: (written.append(name), scratch(spark, name))[1])
    rows = [{"origin": f"A{i % 9}", "month": i % 12, "dep_delay": float(i)} for i in range(300)] * 2
    f = make_flights(spark, [*rows, {"origin": None}])
    base = scratch_path(spark, "t_open")
    for sizes in ([0.25, 0.5, 1, 2], [1, 2, 4], [0.5], [1]):
        paths = D.write_sizes(f, base, sizes)
        # Spark sorts the rest of a task's rows once as many files as asked for are open
        assert asked.pop() > len([s for s in sizes if s != 1 or min(sizes) == 1])
        assert [spark.read.parquet(paths[s]).count() for s in sizes] == [D.wanted_rows(601, s) for s in sizes]
        # the rows of size 1 are written once
        assert ("cleaned" in written) == (sizes == [0.5])
        written.clear()
    assert spark.read.parquet(D.dataset_path(base, 1)).exceptAll(f).count() == 0


def test_shuffle_files_go_with_their_job(spark):
    from aerolap.session import shuffles_dropped
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(key) == before


def test_months_outside_the_calendar(spark):
    months = [1, 12, 12, None, 0, 62, 63, 126, -1, -63, -64, 2 ** 31 - 1, -2 ** 31]
    f = make_flights(spark, [{"op_unique_carrier": "C", "origin": "X", "dest": "Y", "month": m} for m in months])
    r = A.route_stats(f).first()
    assert r.months == sorted({m for m in months if m is not None}) and r.num_flights == len(months)
    assert A.route_months(f.where("month IS NULL")).first().months == []
