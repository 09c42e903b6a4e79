from pyspark.sql import functions as F

from wardline.operators import quality as Q
from wardline.plans.checks import WAREHOUSE_CHECKS
from wardline.registry import graph

from conftest import SF_SMALL


def test_generic_checks_on_planted_rows(spark):
    df = spark.createDataFrame(
        [("a", "M", 5, "x"), ("a", "F", -1, "y"), ("b", "X", 200, None), (None, None, None, "q")],
        "id string, gender string, age int, parent string")
    assert {r["id"]: r["n_records"] for r in Q.unique(df, "id").collect()} == {"a": 2}
    assert Q.not_null(df, "id").count() == 1
    bad = {r["gender"]: r["n_records"] for r in Q.accepted_values(df, "gender", ["M", "F"]).collect()}
    assert bad == {"X": 1}  # NULL passes
    assert Q.accepted_range(df, "age", 0, 120).count() == 2  # -1 and 200; NULL passes
    assert Q.accepted_range(df, "age", min_value=0).count() == 1
    parents = spark.createDataFrame([("x",), ("y",)], "pid string")
    assert [r["parent"] for r in Q.relationships(df, "parent", parents, "pid").collect()] == ["q"]


def test_boolean_accepted_values(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "f boolean")
    assert Q.accepted_values(df, "f", [False]).count() == 1  # distinct failing values


def test_overlap_rate_threshold(spark):
    df = spark.createDataFrame([(True,), (False,), (False,)], "overlaps_next_stay boolean")
    assert Q.overlap_rate(df).count() == 1
    assert Q.overlap_rate(df, threshold=0.5).count() == 0
    assert Q.overlap_rate(df.limit(0)).count() == 0


def test_report_statuses_and_counts(spark):
    g = graph(spark, SF_SMALL)
    rep = {r["check_name"]: r for r in Q.run_checks(spark, WAREHOUSE_CHECKS, Q.checkpointed(
        g.model, Q.columns_needed(WAREHOUSE_CHECKS))).collect()}
    assert len(rep) == 56
    # orphans are planted in the mapped data: relationship checks at staging fail
    assert rep["relationships_stg_encounters_patient_id_stg_patients_patient_id"]["status"] == "fail"
    # stop < start is planted: warn, not fail
    inv = rep["accepted_values_fct_encounters_has_invalid_timestamps"]
    assert inv["status"] == "warn" and inv["failures"] == 1
    # the code 99999999 is not in the seed, nor is no code; both occur with two descriptions (one row each)
    assert rep["assert_seed_covers_inpatient_codes"]["failures"] == 4
    assert rep["unique_fct_readmissions_index_stay_id"]["status"] == "pass"
    # the single-pass report agrees with the per-check failing rows
    detail = Q.failures_of([c for c in WAREHOUSE_CHECKS if c.kind == "relationships"], g.model)
    n = detail.filter(F.col("check_name") == "relationships_stg_encounters_patient_id_stg_patients_patient_id") \
        .agg(F.sum("n_records")).first()[0]
    assert n == rep["relationships_stg_encounters_patient_id_stg_patients_patient_id"]["failures"]


def test_raise_on_errors(spark):
    rep = spark.createDataFrame([("a", "fail", 3), ("b", "warn", 1)], "check_name string, status string, failures long")
    try:
        Q.raise_on_errors(rep)
    except AssertionError as e:
        assert "a=3" in str(e) and "b" not in str(e).split(":")[1]
    else:
        raise AssertionError("expected failure")


def test_local_suite(spark):
    from wardline.plans.checks import LOCAL_CHECKS
    g = graph(spark, SF_SMALL)
    assert len(LOCAL_CHECKS) == 56 and sum(c.kind == "singular" for c in LOCAL_CHECKS) == 2
    rep = {r["check_name"]: r for r in Q.run_checks(spark, LOCAL_CHECKS, g.model).collect()}
    ov = rep["accepted_values_fct_readmissions_overlaps_next_stay"]
    assert ov["severity"] == "warn" and ov["status"] == "warn" and ov["failures"] == 1


def test_orphans_are_counted_per_key_before_the_join(spark):
    """The rows must not reach the join, however small the parent looks; NULL keys of either side match nothing."""
    child = spark.range(1000).selectExpr("case when id % 10 = 0 then null else cast(id % 7 as string) end as k")
    parent = spark.range(4).selectExpr("case when id < 3 then cast(id div 2 as string) end as pk")  # 0, 0, 1, NULL
    found = Q.orphan_keys(child, "k", parent, "pk")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("count(1)")  # the count is below the join
    want = {}
    for i in range(1000):
        if i % 10 and i % 7 > 1:
            want[str(i % 7)] = want.get(str(i % 7), 0) + 1
    assert {r["k"]: r["n_records"] for r in found.collect()} == want
    check = Q.Check("relationships", "child", "k", to="parent", field="pk")
    counts = Q.check_failure_counts([check], {"child": child, "parent": parent}.__getitem__)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("count(1)")
    assert [r["failures"] for r in counts.collect()] == [sum(want.values())]
