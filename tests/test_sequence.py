"""Sequencing by ranges equals one window per group."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardline.operators.intermediate import stay_order
from wardline.operators.sequence import sequence_within
from wardline.registry import graph

LEADS = {"next_stay_id": "encounter_id", "next_admitted_at": "started_at", "next_code": "encounter_code"}


def _rows(df):
    return sorted((tuple(r) for r in df.select("encounter_id", "patient_id", "n", *LEADS).collect()), key=str)


def _window(df):
    w = Window.partitionBy("patient_id").orderBy(*stay_order())
    return df.withColumns({"n": F.row_number().over(w), **{o: F.lead(s).over(w) for o, s in LEADS.items()}})


def test_equals_window_on_test_data(spark):
    enriched = graph(spark, "/root/testdata/sf0.01").int_encounters_enriched
    stays = enriched.filter(F.col("encounter_class") == "inpatient").repartition(9, "encounter_id")
    assert _rows(sequence_within(stays, "patient_id", stay_order(), "n", LEADS)) == _rows(_window(stays))


def _hot(spark):
    """One patient holds a third of all stays; ties, NULL starts and stays without a patient."""
    base = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(3000):
        pid = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"p{i % 97}"
        start = None if i % 100 == 0 else base + dt.timedelta(days=(i * 7) % 400)
        rows.append((f"e{i:05d}", pid, start, str(i % 5)))
    return spark.createDataFrame(rows, "encounter_id string, patient_id string, started_at timestamp_ntz, "
                                       "encounter_code string").repartition(7)


def test_hot_patient_is_split_and_exact(spark):
    df = _hot(spark)
    out = sequence_within(df, "patient_id", stay_order(), "n", LEADS)
    assert _rows(out) == _rows(_window(df))
    tasks = out.filter(F.col("patient_id") == "hot").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= 3 and max(r["count"] for r in tasks) <= 600  # of 1000 stays of this patient, in 8 ranges


@pytest.mark.parametrize("ranges,batch", [("1", "10000"), ("8", "1"), ("60", "7"), ("25", "2")])
def test_any_number_of_ranges_and_batches(spark, ranges, batch):
    """Empty ranges, groups over many ranges, ranges of one row, batches that end inside a group."""
    keys = {"spark.sql.shuffle.partitions": ranges, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = _hot(spark).limit(300)
        rows = spark.createDataFrame(df.collect(), df.schema)
        assert _rows(sequence_within(rows, "patient_id", stay_order(), "n", LEADS)) == _rows(_window(rows))
        none = rows.limit(0)
        assert sequence_within(none, "patient_id", stay_order(), "n", LEADS).collect() == []
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_scan_and_one_shuffle_of_the_rows(spark, tmp_dir):
    """The summary of the ranges reads the exchange of the rows, not the input again."""
    _hot(spark).write.parquet(f"{tmp_dir}/stays")
    out = sequence_within(spark.read.parquet(f"{tmp_dir}/stays"), "patient_id", stay_order(), "n", LEADS)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")]
    assert final.count("Scan parquet") == 1 and final.count("+- Exchange rangepartitioning") == 1
    assert final.count("ReusedExchange") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
