"""The driver's test tables and their mapping onto raw clinical tables.

The patient-care source files are not available, so raw tables are
derived from the TPC-H-like test tables with deterministic rules (the
mapping documented in FIXTURES.md §2).  Every derived raw table is a lazy
DataFrame over the test parquet files, so its work grows with them.
"""

from __future__ import annotations

import weakref
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.sources.catalog import RawTables

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
RAW_INPUTS = ("customer", "supplier", "part", "orders", "lineitem")  # of the raw clinical tables


_READS: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; read once per session (the test files are immutable inputs)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    frames = _READS.setdefault(spark, {})
    if path not in frames:
        frames[path] = spark.read.parquet(path)
    return frames[path]


def input_bytes(spark: SparkSession, sf_dir: str, names: Iterable[str] = RAW_INPUTS) -> int:
    """Bytes of the files of the named test tables."""
    total = 0
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        total += fs.getContentSummary(path).getLength()
    return total


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _days_after(base: str, offset: Column) -> Column:
    return F.date_add(F.lit(base).cast("date"), offset.cast("int"))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_test_table(spark, sf_dir, "nation")
    region = read_test_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def raw_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_test_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return (c.join(_geo(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _s(k).alias("id"),
                _days_after("1910-01-01", (k * 7919) % 30600).alias("birthdate"),
                F.when(k % 11 == 0, _days_after("1997-01-01", (k * 13) % 1500)).alias("deathdate"),
                F.when(k % 2 == 0, "M").otherwise("F").alias("gender"),
                F.when(k % 3 == 0, "white").otherwise("black").alias("race"),
                F.when(k % 4 == 0, "hispanic").otherwise("nonhispanic").alias("ethnicity"),
                F.when(k % 7 != 0, F.lit("S")).alias("marital"),
                F.col("c_name").alias("ssn"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                F.col("n_name").alias("county"),
                F.concat(F.lit("0"), _s(k)).alias("zip"),
                F.col("c_acctbal").alias("healthcare_expenses"),
                (F.floor(F.col("c_acctbal") * 50) / 100).alias("healthcare_coverage"),
            ))


# Encounter code by orderkey mod 5 (remainder 0..3; anything else gets the last code).
_ENCOUNTER_CODES = ["410410006", "86013001", "183452005", "185347001", "99999999"]


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_test_table(spark, sf_dir, "orders")
    n_sup = read_test_table(spark, sf_dir, "supplier").select(F.count(F.lit(1))).scalar()
    k = F.col("o_orderkey")
    prio = F.col("o_orderpriority")
    code = F.when(k % 5 == 0, _ENCOUNTER_CODES[0])
    for i, c in enumerate(_ENCOUNTER_CODES[1:-1], start=1):
        code = code.when(k % 5 == i, c)
    code = code.otherwise(_ENCOUNTER_CODES[-1])
    order_day = F.to_date(F.col("o_orderdate"))
    return o.select(
        _s(k).alias("id"),
        # every 47th encounter names a patient that no table has
        F.concat(F.when(k % 47 == 11, "unknown-").otherwise(""), _s("o_custkey")).alias("patient"),
        _s(k % (n_sup - 1)).alias("organization"),
        _s(k % 17).alias("provider"),
        _s(k % 5).alias("payer"),
        F.when(prio.isin("1-URGENT", "2-HIGH"), "inpatient")
         .when(prio == "3-MEDIUM", "emergency")
         .when(prio == "5-LOW", "wellness")
         .otherwise("ambulatory").alias("encounterclass"),
        F.when(k % 53 != 17, code).alias("code"),
        prio.alias("description"),
        F.when(k % 89 != 23, F.col("o_orderdate").cast("timestamp_ntz")).alias("start"),
        F.when(k % 97 != 0,
               F.date_add(order_day, ((k * 7) % 41 - 1).cast("int")).cast("timestamp_ntz")).alias("stop"),
        (F.floor(F.col("o_totalprice") * 60) / 100).alias("base_encounter_cost"),
        (F.col("o_totalprice") + (k % 7) / 1000).alias("total_claim_cost"),
        (F.floor(F.col("o_totalprice") * 80) / 100).alias("payer_coverage"),
        F.when(k % 3 == 0, F.col("o_orderstatus")).alias("reasoncode"),
        F.when(k % 3 == 0, prio).alias("reasondescription"),
    )


def raw_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_test_table(spark, sf_dir, "lineitem")
    o = read_test_table(spark, sf_dir, "orders")
    ship_day = F.to_date(F.col("l_shipdate"))
    # the conditions of every tenth patient are on the next one's record, so some patients have none
    owner = F.when(F.col("o_custkey") % 10 == 3, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat(F.when(F.col("l_orderkey") % 61 == 5, "unknown-").otherwise(""), _s(owner)).alias("patient"),
                _s("l_orderkey").alias("encounter"),
                _s(F.col("l_partkey") % 50).alias("code"),
                F.col("l_linestatus").alias("description"),
                ship_day.alias("start"),
                F.when(F.col("l_returnflag") != "N", F.date_add(ship_day, 30)).alias("stop"),
            ))


def raw_medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_test_table(spark, sf_dir, "lineitem")
    o = read_test_table(spark, sf_dir, "orders")
    p = read_test_table(spark, sf_dir, "part")
    ship_day = F.to_date(F.col("l_shipdate"))
    first_line = F.col("l_linenumber") == 1
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(p, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                _s("o_custkey").alias("patient"),
                _s("l_orderkey").alias("encounter"),
                _s(F.col("o_orderkey") % 5).alias("payer"),
                _s("l_partkey").alias("code"),
                F.col("p_name").alias("description"),
                F.col("l_shipdate").cast("timestamp_ntz").alias("start"),
                F.when(F.col("l_returnflag") != "N",
                       F.date_add(ship_day, 14).cast("timestamp_ntz")).alias("stop"),
                F.col("l_extendedprice").alias("base_cost"),
                (F.floor(F.col("l_extendedprice") * 70) / 100).alias("payer_coverage"),
                F.col("l_quantity").cast("int").alias("dispenses"),
                (F.floor(F.col("l_extendedprice") * F.col("l_quantity") * 100) / 100).alias("totalcost"),
                F.when(first_line, F.col("l_returnflag")).alias("reasoncode"),
                F.when(first_line, F.col("l_linestatus")).alias("reasondescription"),
            ))


def raw_organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_test_table(spark, sf_dir, "supplier")
    return (s.join(_geo(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                _s("s_suppkey").alias("id"),
                F.col("s_name").alias("name"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("state"),
                F.concat(F.lit("0"), _s("s_suppkey")).alias("zip"),
                F.col("s_acctbal").alias("revenue"),
                (F.col("s_suppkey") % 1000).cast("int").alias("utilization"),
            ))


def raw_encounter_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounter-shaped rows from the ``events`` table, used as a change feed."""
    e = read_test_table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        _s("event_id").alias("id"),
        _s("user_id").alias("patient"),
        _s(F.col("event_id") % 9).alias("organization"),
        F.when(et == "error", "emergency").when(et == "purchase", "inpatient")
         .otherwise("ambulatory").alias("encounterclass"),
        F.col("ts").cast("timestamp_ntz").alias("start"),
        F.col("value").alias("total_claim_cost"),
    )


RAW_BUILDERS = {
    "patients": raw_patients,
    "encounters": raw_encounters,
    "conditions": raw_conditions,
    "medications": raw_medications,
    "organizations": raw_organizations,
}


def raw_from_testdata(spark: SparkSession, sf_dir: str) -> RawTables:
    """Raw clinical tables derived from the test tables under ``sf_dir``."""
    return RawTables({name: (lambda f=f: f(spark, sf_dir)) for name, f in RAW_BUILDERS.items()})
