"""The raw flight table derived from the test tables (``lineitem`` x ``orders``).

The reference reads a CSV of real flights that is not part of the test data.
This module builds a table with the same 35 columns from ``lineitem`` joined
to ``orders``, one flight per line item, so that every analysis and check
has something to bite on: codes with blanks (C1), flags stored as doubles
(C2), cancelled flights that still carry a departure delay (C3), diverted
flights with an arrival delay (C4), clocks that cross midnight and shift by
whole hours, and a few inconsistent taxi / air times (Q17, Q18).

The four key columns of the line item are kept in front as row identity.
The expressions are plain integer arithmetic, so DuckDB computes the same
values (see ``plans.oracle``).
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.schema import RAW_COLUMNS
from aerolap.session import checkpoint_base, shuffles_dropped

# Bumped when the derivation or the file layout of the fixture changes.
FIXTURE_VERSION = 3

# Row identity: the line item a flight was made from.
KEY_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

# Fixed values of the fixture: order priority -> cancellation code.
PRIORITY_CODES = {
    "1-URGENT": "A",
    "2-HIGH": "B",
    "3-MEDIUM": "C",
    "4-NOT SPECIFIED": "D",
}


def _hhmm(m: Column) -> Column:
    return F.floor(m / 60).cast("int") * 100 + m % 60


def _unless(cond: Column, value: Column) -> Column:
    return F.when(~cond, value)


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flight table (key columns + the 35 raw columns) for ``sf_dir``."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    )
    od = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")

    ok, pk, sk, ln = (F.col(c) for c in KEY_COLUMNS)
    qty = F.col("l_quantity").cast("int")
    base = j.select(
        *KEY_COLUMNS,
        "l_shipdate",
        "o_custkey",
        "o_orderpriority",
        (pk + ok).alias("k"),
        (((pk * 31 + ok * 17 + ln * 7) % 240).cast("int") - 60).alias("d0"),
        (qty - 25).alias("a0"),
        ((pk * 13 + sk * 29) % 1440).cast("int").alias("cdm"),
        (ln * 3 + 5).alias("to0"),
        (qty * 5 + 30).alias("air0"),
        ((sk % 10).cast("int") + 3).alias("ti0"),
        ((pk % 4).cast("int") * 60).alias("tz"),
        ((ok + ln) % 103 == 0).alias("taxi_gap"),
        ((ok + ln) % 101 == 0).alias("air_bump"),
    )
    canc_b = (F.col("k") % 50) == 0
    staged = base.select(
        "*",
        canc_b.alias("canc_b"),
        (((F.col("k") % 97) == 1) & ~canc_b).alias("div_b"),
        ((F.col("cdm") + F.col("d0") + 1440) % 1440).alias("dep_m"),
    )
    staged = staged.withColumn("wo_m", (F.col("dep_m") + F.col("to0")) % 1440)
    staged = staged.withColumn("wn_m", (F.col("wo_m") + F.col("air0") + F.col("tz")) % 1440)
    staged = staged.withColumn("arr_m", (F.col("wn_m") + F.col("ti0")) % 1440)

    canc = F.col("canc_b")
    d0 = F.col("d0")
    code = None
    for prio, letter in PRIORITY_CODES.items():
        cond = F.col("o_orderpriority") == prio
        code = F.when(cond, F.lit(letter)) if code is None else code.when(cond, F.lit(letter))
    causes_ok = ~canc & (d0 >= 15)
    cause_rules = {
        "carrier_delay": pk % 2 == 0,
        "weather_delay": pk % 9 == 0,
        "nas_delay": pk % 3 == 0,
        "security_delay": pk % 101 == 0,
        "late_aircraft_delay": pk % 4 == 1,
    }
    ship = F.col("l_shipdate")
    to0, air0, ti0 = F.col("to0"), F.col("air0"), F.col("ti0")
    cols = {
        "year": F.year(ship).cast("int"),
        "month": F.month(ship).cast("int"),
        "day_of_month": F.dayofmonth(ship).cast("int"),
        "day_of_week": (F.weekday(ship) + 1).cast("int"),
        "fl_date": F.to_date(ship),
        "op_unique_carrier": F.concat(F.lit(" c"), (pk % 12).cast("string"), F.lit(" ")),
        "op_carrier_fl_num": sk.cast("double"),
        "origin": F.concat(F.lit("a"), (ok % 25).cast("string")),
        "origin_city_name": F.concat(F.lit("City "), (ok % 25).cast("string"), F.lit(", ST")),
        "origin_state_nm": F.lit("State"),
        "dest": F.concat(F.lit("A"), (F.col("o_custkey") % 25).cast("string"), F.lit(" ")),
        "dest_city_name": F.concat(
            F.lit("City "), (F.col("o_custkey") % 25).cast("string"), F.lit(", ST")
        ),
        "dest_state_nm": F.lit("State"),
        "crs_dep_time": _hhmm(F.col("cdm")),
        "dep_time": _unless(canc, _hhmm(F.col("dep_m")).cast("double")),
        "dep_delay": F.when(~canc | (ln == 3), d0.cast("double")),
        "taxi_out": _unless(canc | F.col("taxi_gap"), to0.cast("double")),
        "wheels_off": _unless(canc, _hhmm(F.col("wo_m")).cast("double")),
        "wheels_on": _unless(canc, _hhmm(F.col("wn_m")).cast("double")),
        "taxi_in": _unless(canc, ti0.cast("double")),
        "crs_arr_time": _hhmm(
            (F.col("arr_m") - d0 - F.col("a0") + 2880) % 1440
        ),
        "arr_time": _unless(canc, _hhmm(F.col("arr_m")).cast("double")),
        "arr_delay": _unless(canc, (d0 + F.col("a0")).cast("double")),
        "cancelled": canc.cast("int").cast("double"),
        "cancellation_code": F.when(canc & (ln < 7), code),
        "diverted": F.col("div_b").cast("int").cast("double"),
        "crs_elapsed_time": (to0 + air0 + ti0).cast("double"),
        "actual_elapsed_time": _unless(canc, (to0 + air0 + ti0).cast("double")),
        "air_time": _unless(
            canc, (air0 + F.when(F.col("air_bump"), 1).otherwise(0)).cast("double")
        ),
        "distance": (air0 * 8).cast("double"),
    }
    for name, rule in cause_rules.items():
        cols[name] = F.when(causes_ok & rule, d0).otherwise(F.lit(0)).cast("int")
    return staged.select(*KEY_COLUMNS, *[cols[n].alias(n) for n in RAW_COLUMNS])


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the inputs: every file's path, size and modification time,
    as the file system that Spark reads them from tells them."""
    sc = spark.sparkContext
    parts = []
    for t in ("lineitem", "orders"):
        p = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        top = fs.getFileStatus(p)
        for f in fs.listStatus(p) if top.isDirectory() else [top]:
            parts.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("|".join([*sorted(parts), f"layout={FIXTURE_VERSION}"]).encode()
                        ).hexdigest()[:16]


def load_raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw flight table of ``sf_dir``, written once as Parquet and read back.

    The derivation is materialised in the shared checkpoint folder (keyed by
    the input files), so every query scans plain columns as it would scan the
    real raw file, instead of re-running the join and inlining the derived
    clock arithmetic into each filter. A caller writes to a folder of its own
    and renames it to a numbered place below the key; readers take the lowest
    finished number, so callers that race each other do no harm.
    """
    sc = spark.sparkContext
    mk = sc._jvm.org.apache.hadoop.fs.Path
    root = f"{checkpoint_base(spark)}/aerolap/raw_flights/{_fingerprint(spark, sf_dir)}"
    fs = mk(root).getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(mk(root))

    def finished() -> str | None:
        names = sorted(f.getPath().getName() for f in fs.listStatus(mk(root)))
        return next((f"{root}/{n}" for n in names if n.startswith("done-")
                     and fs.exists(mk(f"{root}/{n}/_SUCCESS"))), None)

    path = finished()
    if path is None:
        own = uuid.uuid4().hex[:12]
        staged = f"{root}/.staged-{own}"
        with shuffles_dropped(spark):
            raw_flights(spark, sf_dir).write.parquet(staged)
        if not fs.rename(mk(staged), mk(f"{root}/done-{own}")):
            raise OSError(f"cannot publish {staged}")
        path = finished()
    return spark.read.parquet(path)
