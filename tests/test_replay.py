"""Replays and restarts: no duplicates, same state."""

from pyspark.sql import functions as F

from wardline.plans.sinks import read_table
from wardline.registry import graph
from wardline.streaming.capture import write_batch_partition
from wardline.streaming.realtime import MART, apply_increment, organization_kpis_rt

from conftest import SF_SMALL


def test_replayed_capture_batch_does_not_duplicate(spark, tmp_dir):
    df = spark.range(100).withColumn("cdc_action", F.lit("INSERT"))
    write_batch_partition(df, tmp_dir, 0)
    write_batch_partition(df.filter("id < 50"), tmp_dir, 1)
    write_batch_partition(df.filter("id < 50"), tmp_dir, 1)  # replay after a failure
    assert spark.read.parquet(tmp_dir).count() == 150


def test_replayed_increment_gives_same_totals(spark, tmp_dir):
    g = graph(spark, SF_SMALL)
    raw = g.raw["encounters"]
    first, second = raw.filter(F.col("id").cast("long") % 2 == 0), raw.filter(F.col("id").cast("long") % 2 == 1)
    apply_increment(spark, first, 0, g.stg_patients, tmp_dir)
    a = sorted(tuple(r) for r in apply_increment(spark, second, 1, g.stg_patients, tmp_dir).collect())
    b = sorted(tuple(r) for r in apply_increment(spark, second, 1, g.stg_patients, tmp_dir).collect())
    assert a == b
    total = sum(r[1] for r in a)
    assert total == g.int_encounters_enriched.count()


def test_realtime_restart_mid_stream(spark, tmp_dir):
    g = graph(spark, SF_SMALL)
    raw = g.raw["encounters"]
    landing, sink, ckpt = f"{tmp_dir}/enc", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    k = F.col("id").cast("long")
    raw.filter(k < 600).repartitionByRange(2, "id").write.parquet(landing)

    def run():
        q = organization_kpis_rt(spark, landing, raw.schema, g.stg_patients, g.dim_organizations, sink, ckpt,
                                 mode="incremental", trigger="availableNow", max_files_per_trigger=1)
        q.awaitTermination()

    run()
    raw.filter(k >= 600).repartitionByRange(3, "id").write.mode("append").parquet(landing)
    run()  # restart from the checkpoint: only the new files are folded in
    got = {r["organization_id"]: r["total_encounters"] for r in read_table(spark, sink, MART).collect()}
    want = {r["organization_id"]: r["total_encounters"] for r in g.mart_organization_kpis.collect()}
    assert got == want


def test_byte_budget_splits_a_backlog(spark, tmp_dir):
    from wardline.streaming.capture import capture_appends
    df = spark.range(20000).selectExpr("cast(id as string) as id", "id % 7 as v")
    df.repartition(6).write.parquet(f"{tmp_dir}/landing")
    spark.conf.set("wardline.stream.maxBytesPerTrigger", "1")  # at least one file per batch
    try:
        capture_appends(spark, f"{tmp_dir}/landing", df.schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                        starting="earliest", trigger="availableNow").awaitTermination()
    finally:
        spark.conf.unset("wardline.stream.maxBytesPerTrigger")
    out = spark.read.parquet(f"{tmp_dir}/sink")
    assert out.count() == 20000
    assert out.select("batch_id").distinct().count() > 1


def test_merging_the_distinct_state_is_exact_and_replay_safe(spark, tmp_dir):
    import os
    g = graph(spark, SF_SMALL)
    raw = g.raw["encounters"]
    k = F.col("id").cast("long")
    batches = [raw.filter(k % 6 == i) for i in range(6)]

    def run(root, every, replay=None):
        out = None
        for i, b in enumerate(batches):
            out = apply_increment(spark, b, i, g.stg_patients, root, compact_every=every)
            if replay == i:  # a replay of a batch that merged versions
                out = apply_increment(spark, b, i, g.stg_patients, root, compact_every=every)
        return sorted(tuple(r) for r in out.collect())

    plain = run(f"{tmp_dir}/plain", 0)
    compacted = run(f"{tmp_dir}/compacted", 2, replay=4)
    assert plain == compacted
    left = sorted(n for n in os.listdir(f"{tmp_dir}/compacted/distinct/manifests") if not n.startswith("."))
    assert left == ["4.json", "5.json"]
    # distinct patients per organization equal the batch answer
    want = {r["organization_id"]: r["distinct_patients"] for r in g.mart_organization_kpis.collect()
            if r["distinct_patients"] is not None}
    got = {r[0]: r[-1] for r in compacted}
    assert got == want


def test_capture_survives_a_crash_mid_batch(spark, tmp_dir):
    import pytest

    import wardline.streaming.capture as C
    df = spark.range(3000).selectExpr("cast(id as string) as id", "id % 11 as v")
    df.repartitionByRange(3, "id").write.parquet(f"{tmp_dir}/landing")
    original = C.write_batch_partition
    crashed = []

    def crash_after_writing(batch, sink, batch_id):
        original(batch, sink, batch_id)
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("simulated loss after the output was written, before the commit")

    C.write_batch_partition = crash_after_writing
    try:
        q = C.capture_appends(spark, f"{tmp_dir}/landing", df.schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                              starting="earliest", trigger="availableNow", max_files_per_trigger=1)
        with pytest.raises(Exception):
            q.awaitTermination()
    finally:
        C.write_batch_partition = original
    assert crashed == [1]
    # restart from the checkpoint: batch 1 is run again and overwrites its own output
    C.capture_appends(spark, f"{tmp_dir}/landing", df.schema, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt",
                      starting="earliest", trigger="availableNow", max_files_per_trigger=1).awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/sink")
    assert out.count() == 3000 and out.select("id").distinct().count() == 3000
    assert sorted(r[0] for r in out.select("batch_id").distinct().collect()) == [0, 1, 2]


def test_realtime_survives_a_crash_mid_batch(spark, tmp_dir):
    import pytest

    import wardline.streaming.realtime as R
    g = graph(spark, SF_SMALL)
    raw = g.raw["encounters"]
    raw.repartitionByRange(3, "id").write.parquet(f"{tmp_dir}/enc")
    original = R.apply_increment
    crashed = []

    def crash_after_state(spark_, batch, batch_id, patients, state_root, compact_every=R.COMPACT_EVERY):
        out = original(spark_, batch, batch_id, patients, state_root, compact_every)
        if batch_id == 1 and not crashed:
            crashed.append(batch_id)
            raise RuntimeError("simulated loss after the state was written, before the mart")
        return out

    R.apply_increment = crash_after_state
    args = (spark, f"{tmp_dir}/enc", raw.schema, g.stg_patients, g.dim_organizations, f"{tmp_dir}/sink",
            f"{tmp_dir}/ckpt")
    try:
        q = R.organization_kpis_rt(*args, mode="incremental", trigger="availableNow", max_files_per_trigger=1)
        with pytest.raises(Exception):
            q.awaitTermination()
    finally:
        R.apply_increment = original
    R.organization_kpis_rt(*args, mode="incremental", trigger="availableNow", max_files_per_trigger=1).awaitTermination()
    got = {r["organization_id"]: (r["total_encounters"], r["distinct_patients"])
           for r in read_table(spark, f"{tmp_dir}/sink", MART).collect()}
    want = {r["organization_id"]: (r["total_encounters"], r["distinct_patients"])
            for r in g.mart_organization_kpis.collect()}
    assert crashed == [1] and got == want
