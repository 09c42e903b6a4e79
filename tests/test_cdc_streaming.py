import os

import pytest

from pyspark.sql import functions as F

from wardline.operators.cdc import multiset_diff, snapshot_diff
from wardline.plans.sinks import read_table
from wardline.registry import QUERIES, graph
from wardline.streaming.capture import capture_appends
from wardline.streaming.realtime import MART, organization_kpis_rt

from conftest import SF_SMALL


def test_snapshot_diff_actions(spark):
    prev = spark.createDataFrame([("1", "a", None), ("2", "b", 1), ("3", "c", 2), ("4", "d", 3)],
                                 "id string, v string, n int")
    curr = spark.createDataFrame([("1", "a", 5), ("2", "b", 1), ("3", "z", 2), ("5", "e", 4)],
                                 "id string, v string, n int")
    got = sorted((r["id"], r["cdc_action"], r["cdc_is_update"], r["v"], r["n"])
                 for r in snapshot_diff(prev, curr, "id").collect())
    assert got == [("1", "DELETE", True, "a", None), ("1", "INSERT", True, "a", 5),
                   ("3", "DELETE", True, "c", 2), ("3", "INSERT", True, "z", 2),
                   ("4", "DELETE", False, "d", 3), ("5", "INSERT", False, "e", 4)]


def test_snapshot_diff_null_keys(spark):
    prev = spark.createDataFrame([(None, "a"), ("1", "b")], "id string, v string")
    curr = spark.createDataFrame([(None, "a"), ("1", "b")], "id string, v string")
    got = sorted((r["id"] or "", r["cdc_action"]) for r in snapshot_diff(prev, curr, "id").collect())
    assert got == [("", "DELETE"), ("", "INSERT")]


def test_multiset_diff_counts_copies(spark):
    prev = spark.createDataFrame([("p", "c1")] * 3 + [("p", "c2")], "patient string, code string")
    curr = spark.createDataFrame([("p", "c1")] * 1 + [("p", "c2"), ("q", None)], "patient string, code string")
    got = sorted(tuple(r) for r in multiset_diff(prev, curr).collect())
    assert got == [("p", "c1", "DELETE", 2), ("q", None, "INSERT", 1)]


def _land(spark, df, path, files):
    df.repartitionByRange(files, "id").write.mode("append").parquet(path)


def test_capture_is_exactly_once_and_starts_latest(spark, tmp_dir):
    raw = graph(spark, SF_SMALL).raw["encounters"].select("id", "patient", "organization", "encounterclass",
                                                          "start", "total_claim_cost")
    old, new = raw.filter(F.col("id").cast("long") < 500), raw.filter(F.col("id").cast("long") >= 500)
    landing, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    _land(spark, old, landing, 2)  # present before capture starts: not captured
    q = capture_appends(spark, landing, raw.schema, sink, ckpt, trigger="availableNow")
    q.awaitTermination()
    _land(spark, new, landing, 3)
    q = capture_appends(spark, landing, raw.schema, sink, ckpt, trigger="availableNow", max_files_per_trigger=1)
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == new.count()
    assert out.select("id").distinct().count() == new.count()
    # a replayed batch overwrites its own partition: run again, still no duplicates
    q = capture_appends(spark, landing, raw.schema, sink, ckpt, trigger="availableNow")
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == new.count()
    assert {r[0] for r in out.select("cdc_action").distinct().collect()} == {"INSERT"}


def test_realtime_incremental_equals_full_and_batch(spark, tmp_dir):
    g = graph(spark, SF_SMALL)
    raw = g.raw["encounters"]
    landing = f"{tmp_dir}/enc"
    _land(spark, raw, landing, 4)
    results = {}
    for mode in ("incremental", "full"):
        sink, ckpt = f"{tmp_dir}/{mode}/sink", f"{tmp_dir}/{mode}/ckpt"
        q = organization_kpis_rt(spark, landing, raw.schema, g.stg_patients, g.dim_organizations, sink, ckpt,
                                 mode=mode, trigger="availableNow", max_files_per_trigger=1)
        q.awaitTermination()
        results[mode] = sorted(tuple(r) for r in read_table(spark, sink, MART).drop("_dt_refreshed_at").collect())
    batch = sorted(tuple(r) for r in g.mart_organization_kpis.select(
        "organization_id", "organization_name", "city", "state", "total_encounters", "distinct_patients",
        "emergency_encounters", "emergency_share_pct", "avg_duration_minutes", "total_claim_cost",
        "total_out_of_pocket").collect())
    assert results["incremental"] == results["full"] == batch
    assert os.path.isdir(f"{tmp_dir}/incremental/ckpt-state/distinct/bitmaps")


def test_ingest_stream(spark):
    df = QUERIES["ingest_raw_stream"](spark, SF_SMALL)
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def _changes(spark, sink, snapshot):
    df = spark.read.parquet(f"{sink}").filter(F.col("snapshot_id") == snapshot)
    return sorted((r["id"], r["v"], r["cdc_action"], r["cdc_is_update"]) for r in df.collect())


def test_snapshot_change_stream(spark, tmp_dir):
    """Several files per snapshot, several snapshots waiting, and a byte budget that must not matter."""
    from wardline.streaming.capture import capture_snapshot_changes, commit_snapshot
    root, sink, ckpt = f"{tmp_dir}/snaps", f"{tmp_dir}/changes", f"{tmp_dir}/ckpt"

    def snap(rows):
        return spark.createDataFrame(rows, "id string, v int").repartition(3)

    def capture():
        capture_snapshot_changes(spark, root, snap([]).schema, "id", sink, ckpt, trigger="availableNow"
                                 ).awaitTermination()

    spark.conf.set("wardline.stream.maxBytesPerTrigger", "1")
    try:
        commit_snapshot(snap([(f"k{i}", i) for i in range(90)]), root, "s1")
        capture()
        commit_snapshot(snap([(f"k{i}", i if i % 2 else -i) for i in range(1, 91)]), root, "s2")
        commit_snapshot(snap([("k1", 1)]), root, "s3")
        capture()
    finally:
        spark.conf.unset("wardline.stream.maxBytesPerTrigger")
    assert _changes(spark, sink, "s1") == sorted((f"k{i}", i, "INSERT", False) for i in range(90))
    want = [("k0", 0, "DELETE", False), ("k90", -90, "INSERT", False)]
    want += [(f"k{i}", v, a, True) for i in range(2, 90, 2) for v, a in ((i, "DELETE"), (-i, "INSERT"))]
    assert _changes(spark, sink, "s2") == sorted(want)
    assert len(_changes(spark, sink, "s3")) == 89
    commit_snapshot(snap([("k1", 1)]), root, "s2b")
    with pytest.raises(Exception, match="had been captured"):
        capture()


def test_snapshot_with_a_repeated_key_is_refused(spark):
    from wardline.operators.cdc import snapshot_diff
    a = spark.createDataFrame([("k", 1), ("k", 1)], "id string, v int")
    with pytest.raises(Exception, match="more than once"):
        snapshot_diff(a, a, "id").collect()


@pytest.mark.parametrize("mode", ["full", "incremental"])
def test_patients_may_arrive_after_their_encounters(spark, tmp_dir, mode):
    from wardline.operators.staging import stg_patients
    g = graph(spark, SF_SMALL)
    raw, people = g.raw["encounters"], g.raw["patients"]
    landing, patients, loaded = f"{tmp_dir}/enc", f"{tmp_dir}/patients", f"{tmp_dir}/loaded"
    third = F.pmod(F.xxhash64("id"), F.lit(3))
    raw.filter(third == 0).write.parquet(loaded)
    for part, who in ((1, F.pmod(F.xxhash64("id"), F.lit(2)) == 0), (2, F.pmod(F.xxhash64("id"), F.lit(2)) == 1)):
        people.filter(who).write.mode("append").parquet(patients)
        raw.filter(third == part).write.mode("append").parquet(landing)
        organization_kpis_rt(spark, landing, raw.schema, lambda: stg_patients(spark.read.parquet(patients)),
                             g.dim_organizations, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", mode=mode,
                             trigger="availableNow", history=lambda: spark.read.parquet(loaded)).awaitTermination()
    mart = read_table(spark, f"{tmp_dir}/sink", MART)
    assert mart.agg(F.sum("total_encounters")).first()[0] == g.int_encounters_enriched.count()


def test_streamed_rows_join_the_batch_raw_table(spark, tmp_dir):
    from wardline.plans.graph import ModelGraph
    from wardline.sources.catalog import RawTables
    from wardline.sources.testdata import raw_encounter_events
    from wardline.streaming.ingest import TEXT_TS_OPTIONS, ingest_raw_stream
    g = graph(spark, SF_SMALL)
    events = raw_encounter_events(spark, SF_SMALL)
    events.repartitionByRange(3, "id").write.options(**TEXT_TS_OPTIONS).json(f"{tmp_dir}/landing")
    ingest_raw_stream(spark, f"{tmp_dir}/landing", events.schema, f"{tmp_dir}/streamed", f"{tmp_dir}/ckpt",
                      trigger="availableNow").awaitTermination()
    raw = RawTables.from_frames({n: g.raw[n] for n in g.raw}).with_stream("encounters", f"{tmp_dir}/streamed")
    both = ModelGraph(spark, raw, as_of="2024-01-01").stg_encounters
    assert both.count() == g.stg_encounters.count() + events.count()
    assert both.filter(F.col("stopped_at").isNull()).count() >= events.count()  # columns the stream lacks are NULL


def test_diffs_shuffle_each_row_once(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "id string, x int")
    new = spark.createDataFrame([("b", 2), ("c", None), ("c", None)], "id string, x int")
    same_size = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in same_size}
    try:
        for k, v in same_size.items():
            spark.conf.set(k, v)
        for df, shuffles in ((multiset_diff(old, new), 1), (snapshot_diff(old, new, "id"), 2)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning(_row") + plan.count("Exchange hashpartitioning(id") == shuffles
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = {tuple(r) for r in multiset_diff(old, new).collect()}
    assert got == {("a", 1, "DELETE", 1), ("b", 2, "DELETE", 1), ("c", None, "INSERT", 2)}
