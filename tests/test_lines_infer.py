"""CSV records with their lines over many splits, and inferred types."""

from __future__ import annotations

import csv
import random

import pytest
from pyspark.sql import types as T

from aerolap import sources as S
from aerolap.functions import _util as U
from aerolap.session import scratch_path
from aerolap.sources import files as F
from aerolap.sources import infer as I
from aerolap.sources import lines as L
from tests.conftest import SF_SMALL

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


@pytest.fixture
def split_bytes(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def put(n: int) -> None:
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")
    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


def _files(folder, seed: int):
    """Three files with empty lines, quotes, separators and line ends in values."""
    rng, want = random.Random(seed), []
    for name, end in (("f0", "\n"), ("f1", "\r\n"), ("f2", "\n")):
        record, line = 2, 2
        with open(folder / f"{name}.csv", "w", newline="") as fh:
            w = csv.writer(fh, lineterminator=end)
            w.writerow(["B", "a"] if name == "f2" else ["A", "b"])
            for i in range(150):
                if rng.random() < .1:
                    fh.write(end)
                    line += 1
                v = rng.choice(["x", 'q"q', "a,b", "l1\nl2", "\n\n", 'he said "\n" and', "", '"', "é" * 50])
                w.writerow([v, i] if name == "f2" else [i, v])
                want.append((f"{name}.csv", line, record, i, v))
                record, line = record + 1, line + 1 + v.count("\n")
    return sorted(want)


@pytest.mark.parametrize("size", [61, 509, 10 ** 6])
def test_lines_and_records_over_splits(spark, tmp_path, split_bytes, size):
    want = _files(tmp_path, size)
    split_bytes(size)
    rows = L.read_raw_csv_lines(spark, str(tmp_path), SCHEMA, na_tokens=["nothing"]).collect()
    got = sorted((r.source_file.rsplit("/", 1)[1], r.source_line, r.source_record, r.a, r.b or "")
                 for r in rows)
    assert got == want


def test_plain_files_move_no_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n\n2,y")
    df = L.read_raw_csv_lines(spark, str(tmp_path), SCHEMA)
    assert [(r.a, r.source_line, r.source_record) for r in df.orderBy("a").collect()] == [(1, 2, 2), (2, 4, 3)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    (tmp_path / "a.csv").write_text("a,b\n")
    assert L.read_raw_csv_lines(spark, str(tmp_path), SCHEMA).count() == 0


def test_kinds_and_bounds(spark):
    cells = {"1": 1, "-7": 1, " 12 ": 1, "2147483647": 1, "2147483648": 2, "9" * 18: 2, "9" * 30: 4, "1.5": 4,
             "1.": 4, ".5e3": 4, "2024-02-29": 8, "2023-02-29": 16, "2024-2-9": 16, "12d": 16, "x": 16, "": 0,
             "NA": 0, None: 0, "+": 16}
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = {r.c: r.k for r in df.select("c", I.kind(df["c"]).alias("k")).collect()}
    assert got == cells
    names = {s: I.upper_bound(s).simpleString() for s in range(32)}
    assert names[0] == "string" and names[1] == "int" and names[2] == names[3] == "bigint"
    assert {names[s] for s in (4, 5, 6, 7)} == {"double"} and names[8] == "date"
    assert {names[s] for s in range(9, 32)} == {"string"}


def test_states_of_files_merge_and_widen(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,d\n1,2,2024-01-01\n3,NA,\n")
    (tmp_path / "b.csv").write_text('Y,X,z\n2.5,99999999999,"a,b"\n')
    path = str(tmp_path)
    states = I.column_states(spark, path)
    assert states.count() == 6
    assert I.merge_states(states) == {"x": 3, "y": 5, "d": 8, "z": 16}
    df = I.read_csv_inferred(spark, path)
    assert df.schema.simpleString() == "struct<x:bigint,y:double,d:date,z:string>"
    rows = {r.x: (r.y, str(r.d), r.z) for r in df.collect()}
    assert rows == {1: (2.0, "2024-01-01", None), 3: (None, "None", None), 99999999999: (2.5, "None", "a,b")}


def test_pieces_of_a_folder_are_numbered_as_one_file(spark, tmp_path, split_bytes):
    rows = [["a", "b"], *[[str(i), f"l{i}\nm" if i % 3 else f"x{i}"] for i in range(40)]]
    (tmp_path / "whole").mkdir()
    (tmp_path / "cut").mkdir()
    with open(tmp_path / "whole" / "f.csv", "w", newline="") as fh:
        csv.writer(fh, lineterminator="\n").writerows(rows)
    for k, (a, b) in enumerate([(1, 8), (8, 8), (8, 30), (30, 41)]):
        with open(tmp_path / "cut" / f"part-{k}.csv", "w", newline="") as fh:
            csv.writer(fh, lineterminator="\n").writerows([rows[0], *rows[a:b]])
    split_bytes(37)
    places = ["a", "b", "source_line", "source_record"]
    want = L.read_raw_csv_lines(spark, str(tmp_path / "whole"), SCHEMA).select(*places).collect()
    got = L.read_raw_csv_lines(spark, str(tmp_path / "cut"), SCHEMA, folders=True).select(*places).collect()
    assert len(got) == 40 and sorted(got) == sorted(want)


def test_cells_without_pattern_are_the_numbers_of_the_pattern(spark):
    cells = ["1", "-7", " 12 ", "+3", "1.5", "1.", ".5e3", "1e5", "12d", "1f", "0x1p3", "-0x1.8p1", "+Infinity",
             "-inf", "NaN", "", None, "1996-03-13", "1,5", "12\x01", "\x0112", "12\t", "x", "-", "1 2", "9" * 30]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    for r in df.select("c", U.cell_number(df["c"]).alias("n"), U.text_number(df["c"]).alias("t")).collect():
        assert r.n == r.t, r.c


def test_obvious_cells_have_the_kind_of_all_cells(spark, tmp_path):
    cells = ["1", "+12", "-123456789", "1234567890", "9" * 18, "9" * 30, "1.5", "-0.25", "1.", ".5", "1e5", "12d",
             "2024-02-29", "2023-02-29", "NA", "x", "Zed", "NaN", "nan", "Infinity", " 7", "7 ", "é"]
    for k, c in enumerate(cells):
        with open(tmp_path / f"{k:02d}.csv", "w", newline="") as fh:
            csv.writer(fh).writerows([["v", "w"], [c, "q"]])
    got = {r.source_file[-6:-4]: r.state for r in I.column_states(spark, str(tmp_path)).where("column = 'v'").collect()}
    df = spark.createDataFrame([(f"{k:02d}", c) for k, c in enumerate(cells)], "k string, c string")
    assert got == {r.k: r.s for r in df.select("k", I.kind(df["c"]).alias("s")).collect()}


def test_text_cells_keep_the_projection_out_of_one_long_method(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,NA\n-9,y\n12d,\n")
    df = F.read_raw_csv(spark, str(tmp_path), SCHEMA, na_tokens=["NA", "", "-9"])
    assert [(r.a, r.b) for r in df.collect()] == [(1, None), (None, "y"), (None, None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Project" in plan and "*(1) Project" not in plan


def test_packed_files_are_read_as_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(F, "PACKED_ROWS", 7)
    rows = [(i, None if i % 5 == 0 else f'n "{i}"\nb, c' if i % 6 == 0 else f" v{i}", i / 4) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, t string, d double").coalesce(1)
    one = df.where("t NOT LIKE '%\n%' OR t IS NULL")
    plain, packed = (S.write_csv(one, scratch_path(spark, "t_packed"), packed=p) for p in (False, True))
    names = [f.rpartition("/")[2] for f in F._data_files(spark, [packed])]
    assert len(names) == -(-one.count() // 7) and all(n.endswith(".csv.gz") for n in names)
    read = [sorted(map(str, S.read_raw_csv(spark, p, schema=df.schema).collect())) for p in (plain, packed)]
    assert read[0] == read[1] and len(read[0]) == one.count()
    inferred = [S.read_csv_inferred(spark, p) for p in (plain, packed)]
    assert inferred[0].schema == inferred[1].schema and inferred[1].schema["d"].dataType.typeName() == "double"
    assert inferred[0].exceptAll(inferred[1]).count() == 0 and inferred[1].count() == one.count()
    # the lines and records are those of the one file, whatever its pieces
    numbered = []
    for p in (False, True):
        got = S.read_raw_csv_lines(spark, S.write_csv(df, scratch_path(spark, "t_lines"), packed=p),
                                   schema=df.schema, folders=True)
        numbered.append(sorted((r.k, r.t, r.d, r.source_line, r.source_record) for r in got.collect()))
    assert numbered[0] == numbered[1] and len(numbered[0]) == 60
    assert numbered[1][-1][3:] == (61 + sum(1 for i in range(59) if i % 6 == 0 and i % 5), 61)


@pytest.mark.parametrize("name", ["scan_csv_widened", "scan_csv_decimal_ints", "scan_csv_quoted",
                                  "scan_csv_inferred", "dq_bad_rows_lines"])
def test_queries_write_packed_csv(spark, monkeypatch, name):
    from aerolap.plans import catalog
    seen, real = [], S.write_csv
    monkeypatch.setattr(catalog.S, "write_csv", lambda *a, **b: (seen.append(b.get("packed")), real(*a, **b))[1])
    assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    assert seen and all(seen)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
