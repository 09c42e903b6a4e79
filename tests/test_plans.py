"""Plan-shape regressions: pushdown, pruning, broadcast of the seed, one window shuffle."""

import pytest

from wardline.operators.joins import bounded_broadcast
from wardline.plans.graph import ModelGraph
from wardline.plans.load import publish_raw
from wardline.plans.sinks import read_table, write_table
from wardline.registry import QUERIES
from wardline.sources.testdata import raw_from_testdata

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    return publish_raw(raw_from_testdata(spark, SF_SMALL), root)


def test_inpatient_filter_reaches_the_scan_and_columns_are_pruned(spark, loaded):
    g = ModelGraph(spark, loaded, as_of="2024-01-01")
    plan = g.fct_readmissions._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(encounterclass,inpatient)" in plan
    # the readmission fact does not need the patients' identifying or money columns
    assert "ssn" not in plan and "healthcare_expenses" not in plan


@pytest.mark.parametrize("model", ["int_inpatient_stays", "fct_readmissions"])
def test_seed_is_broadcast_and_stays_are_read_and_dealt_once(spark, loaded, model):
    df = ModelGraph(spark, loaded, as_of="2024-01-01").model(model)
    df.collect()
    plan = _plan(df)
    plan = plan[:plan.index("Initial Plan")]
    assert "BroadcastHashJoin" in plan
    assert plan.count("EqualTo(encounterclass,inpatient)") == 1
    assert plan.count("+- Exchange rangepartitioning(patient_id") == 1 and "Exchange hashpartitioning(patient_id" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


MODEL_KEYS = ["int_encounters_enriched", "int_inpatient_stays", "dim_patients", "fct_encounters",
              "fct_readmissions", "mart_organization_kpis", "mart_high_utilizers", "readmission_by_age_band",
              "readmission_code_share", "median_gap_by_code", "dq_seed_coverage", "snapshot_diff"]


@pytest.mark.parametrize("key", MODEL_KEYS)
def test_no_cross_joins_and_no_python_in_plans(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan  # everything stays in the JVM


def test_bounded_broadcast_respects_the_bound(spark):
    small = spark.range(10)
    assert "broadcast" in small.hint("broadcast")._jdf.queryExecution().logical().toString().lower()
    assert bounded_broadcast(small, max_bytes=4000)._jdf.queryExecution().logical().toString() \
        .lower().count("broadcast") == 1
    assert "broadcast" not in bounded_broadcast(spark.range(1000), max_bytes=4000)._jdf.queryExecution() \
        .logical().toString().lower()
    wide = spark.range(10).selectExpr("id", "repeat('x', 1000) as text")  # few rows, many bytes
    assert "broadcast" not in bounded_broadcast(wide, max_bytes=4000)._jdf.queryExecution().logical().toString().lower()


def test_table_versions_and_pointer(spark, tmp_dir):
    write_table(spark.range(3), tmp_dir, "t")
    assert read_table(spark, tmp_dir, "t").count() == 3
    write_table(spark.range(5), tmp_dir, "t")  # a new version; readers switch at once
    assert read_table(spark, tmp_dir, "t").count() == 5
    with pytest.raises(FileNotFoundError):
        read_table(spark, tmp_dir, "missing")
    import os
    for n in range(3):
        write_table(spark.range(n + 10), tmp_dir, "t", keep_versions=2)
    versions = [v for v in os.listdir(f"{tmp_dir}/t") if v.startswith("v")]
    assert len(versions) == 2 and read_table(spark, tmp_dir, "t").count() == 12


def test_pruning_leaves_a_version_that_another_writer_still_holds(spark, tmp_dir):
    import os

    from wardline.plans.sinks import publish_pointer
    slow = f"{tmp_dir}/t/v0000-slow"  # begun first, published last
    spark.range(7).write.parquet(slow)
    for n in range(4):
        write_table(spark.range(n), tmp_dir, "t", keep_versions=2)
    assert os.path.isdir(slow) and read_table(spark, tmp_dir, "t").count() == 3
    publish_pointer(spark, f"{tmp_dir}/t", "v0000-slow", keep=None)
    assert read_table(spark, tmp_dir, "t").count() == 7
    write_table(spark.range(9), tmp_dir, "t", keep_versions=1)
    assert not os.path.isdir(slow) and len([v for v in os.listdir(f"{tmp_dir}/t") if v.startswith("v")]) == 1


def test_pointer_publication(spark, tmp_dir):
    import os

    from wardline.plans.sinks import current_pointer, publish_pointer
    assert current_pointer(spark, f"{tmp_dir}/none") is None
    for v in ("a", "b", "c", "d", "e"):
        publish_pointer(spark, f"{tmp_dir}/p", v)
    assert current_pointer(spark, f"{tmp_dir}/p") == "e"
    assert len([n for n in os.listdir(f"{tmp_dir}/p") if n.startswith("_CURRENT-")]) == 3
    os.makedirs(f"{tmp_dir}/legacy")
    with open(f"{tmp_dir}/legacy/_CURRENT", "w") as f:
        f.write("v1\n")
    assert current_pointer(spark, f"{tmp_dir}/legacy") == "v1"


def test_partitions_follow_the_input(spark):
    """The warehouse build shuffles into more partitions over more input, and leaves the session as it was."""
    from wardline.session import scaled
    from wardline.sources.testdata import input_bytes
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with scaled(spark, 64 << 30) as n:
        assert n == 4096 and spark.conf.get(key) == "4096"
    assert spark.conf.get(key) == before
    with scaled(spark, input_bytes(spark, "/root/testdata/sf0.001")) as n:
        assert n == int(before) and input_bytes(spark, "/root/testdata/sf0.001") > 0
