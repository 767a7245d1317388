"""Scaling (D1-D4) and sources / sinks."""

from __future__ import annotations

import math

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap import sources as S
from aerolap.operators import scale as D
from aerolap.operators.clean import clean
from aerolap.plans.explain import count_nodes, read_schemas
from aerolap.schema import RAW_SCHEMA
from aerolap.session import drop_scratch, scratch_path
from aerolap.sources.fixtures import KEY_COLUMNS, load_raw_flights
from tests.conftest import SF_SMALL


def _flights(spark):
    return clean(load_raw_flights(spark, SF_SMALL))


def test_replicate_rows_and_averages(spark):
    f = _flights(spark)
    n = f.count()
    for k in (2, 4):
        r = D.replicate(f, k)
        assert r.count() == k * n
        a = f.agg(F.avg("arr_delay")).first()[0]
        b = r.agg(F.avg("arr_delay")).first()[0]
        assert abs(a - b) < 1e-9
        assert r.columns == f.columns
        # one scan and a generator, no union and no join
        assert count_nodes(r, "Generate") == 1 and count_nodes(r, "Union") == 0
        assert count_nodes(r, "CartesianProduct") + count_nodes(r, "BroadcastNestedLoopJoin") == 0


def test_scale_dispatch_and_sample_size(spark):
    f = _flights(spark)
    n = f.count()
    assert D.scale(f, 1) is f
    for frac in (0.25, 0.5, 0.75):
        m = D.scale(f, frac).count()
        sd = math.sqrt(n * frac * (1 - frac))
        assert abs(m - n * frac) <= 5 * sd
    with pytest.raises(ValueError):
        D.scale(f, 2.5)
    keyed = D.keyed_sample(f, 0.25, KEY_COLUMNS)
    assert 0 < keyed.count() < n / 2
    again = D.keyed_sample(f.repartition(7), 0.25, KEY_COLUMNS)
    assert keyed.exceptAll(again).count() == 0 and again.exceptAll(keyed).count() == 0


def test_write_sizes_and_manifest(spark):
    f = _flights(spark)
    base = scratch_path(spark, "t_sizes")
    paths = D.write_sizes(f, base, sizes=[0.5, 1, 2])
    assert paths[1].endswith("flights_cleaned_100.parquet")
    assert paths[0.5].endswith("flights_cleaned_50.parquet")
    man = {r.label: r.row_count for r in D.manifest(spark, paths).collect()}
    assert man[100] == 6000 and man[200] == 12000 and 0 < man[50] < 6000


def test_write_sizes_leaves_other_sizes_alone(spark):
    f = _flights(spark)
    base = scratch_path(spark, "t_one_size")
    whole = D.write_sizes(f.limit(7), base, sizes=[1])[1]
    assert set(D.write_sizes(f, base, sizes=[0.5])) == {0.5}
    assert spark.read.parquet(whole).count() == 7


def test_csv_by_header_name_and_standard_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('DEST,origin,month,origin_city_name,extra\n'
                                    'JFK,LAX,1.0,"a ""q"", b",x\nSFO,SEA,12d,,y\n')
    (tmp_path / "b.csv").write_text('month,origin_city_name,origin,dest\n7,plain,ORD,BOS\n')
    schema = T.StructType([RAW_SCHEMA[c] for c in ("origin", "dest", "month", "origin_city_name")])
    got = S.read_raw_csv(spark, str(tmp_path), schema=schema)
    assert sorted(map(tuple, got.collect())) == [
        ("LAX", "JFK", 1, 'a "q", b'), ("ORD", "BOS", 7, "plain"), ("SEA", "SFO", None, None)]
    back = S.read_raw_csv(spark, S.write_csv(got, scratch_path(spark, "t_quotes")), schema=schema)
    assert back.exceptAll(got).count() == 0
    files = list((tmp_path).glob("*.csv"))
    assert files
    (tmp_path / "c.csv").write_text("origin,dest\nA,B\n")
    with pytest.raises(ValueError):
        S.read_raw_csv(spark, str(tmp_path), schema=schema)


def test_csv_round_trip_with_na_tokens(spark):
    path = scratch_path(spark, "t_csv")
    text = spark.createDataFrame(
        [("2024", "NA", " dl ", "", "12x", "1.0", "City, ST"),
         ("2024", "3", "AA", "N/A", "5.5", "0.0", "NULL")],
        "year string, month string, op_unique_carrier string, dep_delay string, "
        "arr_delay string, cancelled string, origin_city_name string",
    )
    S.write_csv(text, path)
    schema = T.StructType([RAW_SCHEMA[c] for c in text.columns])
    rows = S.read_raw_csv(spark, path, schema=schema).orderBy("month").collect()
    assert tuple(rows[0]) == (2024, None, " dl ", None, None, 1.0, "City, ST")
    assert tuple(rows[1]) == (2024, 3, "AA", None, 5.5, 0.0, None)


def test_fixture_csv_round_trip_is_lossless(spark):
    raw = load_raw_flights(spark, SF_SMALL)
    path = S.write_csv(raw, scratch_path(spark, "t_fixture_csv"))
    back = S.read_raw_csv(spark, path, schema=raw.schema)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_pruned_and_declared_reads(spark):
    path = S.write_parquet(_flights(spark), scratch_path(spark, "t_parquet"))
    pruned = S.read_flights(spark, path, columns=["origin", "dep_delay"])
    assert read_schemas(pruned) == [["origin", "dep_delay"]]
    decl = T.StructType([T.StructField("origin", T.StringType()),
                         T.StructField("cancelled", T.IntegerType())])
    d = S.read_declared(spark, path, decl)
    assert d.columns == ["origin", "cancelled"] and d.count() == 6000


def test_tables_lifecycle(spark):
    db = S.ensure_database(spark, "aerolap_test_db", scratch_path(spark, "t_db"))
    f = _flights(spark).select("origin", "month", "dep_delay")
    S.drop_table(spark, db, "t1")
    t = S.save_table(f, db, "t1", scratch_path(spark, "t_t1"))
    assert t.count() == 6000
    S.drop_table(spark, db, "t2")
    S.declare_table(spark, db, "t2", f.schema, scratch_path(spark, "t_t2"))
    out = S.insert_overwrite(f.select("dep_delay", "month", "origin"), db, "t2")
    assert out.columns == ["origin", "month", "dep_delay"]
    out = S.insert_overwrite(f.limit(5), db, "t2")  # overwrite, not append
    assert out.count() == 5
    S.drop_table(spark, db, "t1")
    assert not spark.catalog.tableExists(f"{db}.t1")


def test_layout_paths():
    lay = S.Layout("s3a://bucket")
    assert lay.dataset(0.25) == "s3a://bucket/data/processed/flights_cleaned_25.parquet"
    assert lay.dataset(4) == "s3a://bucket/data/processed/flights_cleaned_400.parquet"
    assert lay.result("task_3_1", 1) == "s3a://bucket/results/task_3_1/task_3_1_100"
    assert S.size_label(0.75) == 75


def test_bad_rows_keep_their_source(spark):
    """Q20 provenance: file (CSV and Parquet) and row index (Parquet)."""
    from aerolap.operators.timechecks import bad_rows
    from aerolap.schema import RAW_COLUMNS

    raw = load_raw_flights(spark, SF_SMALL)
    csv = S.write_csv(raw.select(*RAW_COLUMNS), scratch_path(spark, "t_src_csv"))
    bad = bad_rows(S.read_raw_csv(spark, csv, source_file=True))
    rows = bad.select("source_file").distinct().collect()
    assert bad.count() == 101 and all(r.source_file.endswith(".csv") for r in rows)

    located = bad_rows(S.with_source_rows(raw))
    r = located.orderBy("source_file", "source_row").first()
    again = S.with_source_rows(raw).filter(
        (F.col("source_file") == r.source_file) & (F.col("source_row") == r.source_row)
    ).collect()
    assert len(again) == 1 and again[0].l_orderkey == r.l_orderkey


def test_scratch_belongs_to_the_application(spark):
    import os

    path = scratch_path(spark, "t_owned")
    assert spark.sparkContext.applicationId in path
    S.write_parquet(spark.range(3), path)
    local = path.removeprefix("file:")
    assert os.path.exists(local)
    drop_scratch(spark, path)
    assert not os.path.exists(local)
    with pytest.raises(ValueError):
        drop_scratch(spark, "/tmp/elsewhere")


def test_fixture_follows_changed_input(spark, tmp_path):
    for t in ("lineitem", "orders"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    before = load_raw_flights(spark, str(tmp_path)).count()
    few = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(100)
    few.write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert before == 6000 and load_raw_flights(spark, str(tmp_path)).count() == 100


def test_join_forms_scan_the_flights_once(spark):
    from aerolap.operators import bands as B
    from aerolap.operators import ranking as R

    f = _flights(spark)
    for df in (B.cause_counts(f), B.top_causes(f), B.union_causes(f)):
        assert count_nodes(df, "FileScan") <= 1 and count_nodes(df, "Scan parquet") <= 1
    for joined in (B.band_report_joined(f), R.carrier_ranking_joined(f)):
        # both sides read the written aggregate, not the flights
        assert all("dep_delay" not in s or "cancelled" not in s for s in read_schemas(joined))
