"""Staged overwrites, and analyses from states of files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerolap import sources as S
from aerolap.operators import routes as A
from aerolap.operators import states as ST
from aerolap.session import scratch_path
from aerolap.sources import publish as P
from tests.conftest import make_flights


def _rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("k", "v").collect()), key=repr)


def _table(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_replace_and_failure_midway(spark):
    path = scratch_path(spark, "t_replace")
    S.replace(_table(spark, [(1, "a"), (2, "b")]), path)
    S.replace(_table(spark, [(3, "c")]), path)
    assert _rows(spark, path) == [(3, "c")]
    bad = _table(spark, [(4, "d"), (5, "x")]).repartition(2).withColumn(
        "v", F.when(F.col("v") == "x", F.raise_error(F.lit("dies midway"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="dies midway"):
        S.replace(bad, path)
    assert _rows(spark, path) == [(3, "c")]


def test_only_the_partitions_present(spark):
    path = scratch_path(spark, "t_parts")
    assert S.replace_partitions(_table(spark, [(1, "a"), (2, "b"), (None, "n")]), path, ["k"]) == [
        "k=1", "k=2", "k=__HIVE_DEFAULT_PARTITION__"]
    assert S.replace_partitions(_table(spark, [(2, "c"), (2, "c"), (4, "d")]), path, ["k"]) == ["k=2", "k=4"]
    assert _rows(spark, path) == sorted([(1, "a"), (2, "c"), (2, "c"), (4, "d"), (None, "n")], key=repr)


def test_interrupted_moves_are_undone_or_finished(spark):
    path = scratch_path(spark, "t_recover")
    S.replace(_table(spark, [(1, "a")]), path)
    P._rename(spark, path, P._aside(path))  # stopped between the two renames
    S.recover(spark, path)
    assert _rows(spark, path) == [(1, "a")]
    _table(spark, [(0, "old")]).write.parquet(P._aside(path))  # stopped before the old rows went
    S.recover(spark, path)
    assert _rows(spark, path) == [(1, "a")] and not P._exists(spark, P._aside(path))


def test_states_follow_the_files(spark):
    folder, store = scratch_path(spark, "t_inputs"), scratch_path(spark, "t_states")

    def put(name, rows):
        S.write_parquet(make_flights(spark, [dict(zip(
            ("op_unique_carrier", "origin", "dest", "month", "arr_delay", "cancelled", "dep_delay"), r,
            strict=True)) for r in rows]).coalesce(1), f"{folder}/{name}")

    def check():
        f = spark.read.option("recursiveFileLookup", True).parquet(folder)
        for name, op in (("route_stats", A.route_stats), ("carrier_ranking", ST.ranking.carrier_ranking),
                         ("band_report", ST.bands.band_report)):
            want = op(f)
            got = ST.report(spark, store, name)
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    def update():
        return {n: ST.update(spark, [folder], store, n) for n in ST.ANALYSES}

    put("a", [("AA", "X", "Y", 1, 5.0, 0, 3.0), ("AA", "X", "Y", 70, None, 1, None), (None, None, "Y", None, 1.0, 0, 9.0)])
    put("b", [("AA", "X", "Y", 1, 7.5, 0, 20.0), ("BB", "X", "Z", 12, 2.0, None, 70.0)])
    assert set(update().values()) == {(2, 0)}
    check()
    assert set(update().values()) == {(0, 0)}
    put("c", [("AA", "X", "Y", -3, 1.0, 0, 4.0)])
    put("a", [("AA", "X", "Y", 2, 50.0, 0, 33.0)])
    assert set(update().values()) == {(2, 1)}
    check()
    P.drop_folder(spark, f"{folder}/b")
    assert set(update().values()) == {(0, 1)}
    check()


def test_open_writers_write_unsorted_and_restore_the_session(spark, tmp_path):
    from aerolap.session import open_writers
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), open_writers(spark, 3):
        spark.range(30).selectExpr("id", "id % 3 AS p").coalesce(1).write.partitionBy("p").parquet(
            str(tmp_path / "t"))
        assert spark.conf.get(key) == "3"
        raise ZeroDivisionError
    assert spark.conf.get(key) == before
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("p").count().collect() and spark.read.parquet(
        str(tmp_path / "t")).count() == 30
