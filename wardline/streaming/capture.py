"""Append-only change capture from a landing folder, exactly once.

Every micro-batch is written to its own ``batch_id=N`` partition with
overwrite: the checkpoint records which files a batch consumed, so a
batch replayed after a failure rewrites the same partition instead of
appending duplicates.  ``starting="latest"`` first records the files
already present (a no-op pass that only commits offsets), so capture
begins with files that arrive after it is created.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(
        jvm.org.apache.hadoop.fs.Path(f"{path}/offsets"))


DEFAULT_MAX_BYTES_PER_TRIGGER = str(10 << 30)


def file_stream(spark: SparkSession, source_dir: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """A file-source stream whose micro-batches are bounded.

    Without a file limit, a byte budget (``wardline.stream.maxBytesPerTrigger``,
    default 10 GB) applies, so a backlog (e.g. ``starting="earliest"`` over a
    large landing folder) drains as several bounded batches, not one.
    """
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        r = r.option("maxBytesPerTrigger",
                     spark.conf.get("wardline.stream.maxBytesPerTrigger", DEFAULT_MAX_BYTES_PER_TRIGGER))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(source_dir)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def record_baseline(spark: SparkSession, source_dir: str, schema: T.StructType, checkpoint: str,
                    fmt: str = "parquet") -> None:
    """Mark every file already in ``source_dir`` as consumed without reading it.

    One micro-batch takes all present files (no byte budget: the no-op sink
    never reads them), so a large landing folder costs one offset entry.
    """
    q = (file_stream(spark, source_dir, schema, fmt, max_files_per_trigger=2**31 - 1).writeStream
         .foreachBatch(lambda df, batch_id: None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def encounter_stream_columns() -> list[Column]:
    """Captured encounter columns: identifiers, class, start and raw claim cost."""
    return [F.col("id").alias("encounter_id"), F.col("patient").alias("patient_id"),
            F.col("organization").alias("organization_id"), F.col("encounterclass").alias("encounter_class"),
            F.col("start").alias("started_at"), F.col("total_claim_cost").alias("total_claim_cost")]


def write_batch_partition(df: DataFrame, sink_dir: str, batch_id: int) -> None:
    """Idempotent append: batch ``batch_id`` owns ``batch_id=N`` and a replay overwrites it.

    The (bounded) micro-batch is rebalanced first, so AQE writes a few files
    of the advisory size instead of one small file per task.
    """
    df.hint("rebalance").write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")


def capture_appends(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str,
                    checkpoint: str, starting: str = "latest", fmt: str = "parquet",
                    trigger: str | None = "1 minute", max_files_per_trigger: int | None = None,
                    transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Capture rows of new files into ``sink_dir`` as INSERT changes.

    Adds ``cdc_action`` = INSERT, ``cdc_is_update`` = false and
    ``_captured_at``.  ``trigger`` is a processing-time interval, or
    ``"availableNow"`` / None to drain what is there and stop.
    """
    if starting not in ("latest", "earliest"):
        raise ValueError("starting must be 'latest' or 'earliest'")
    if starting == "latest" and not _exists(spark, checkpoint):
        record_baseline(spark, source_dir, schema, checkpoint, fmt)
    rows = file_stream(spark, source_dir, schema, fmt, max_files_per_trigger)
    rows = transform(rows) if transform else rows
    rows = rows.withColumns({"cdc_action": F.lit("INSERT"), "cdc_is_update": F.lit(False),
                             "_captured_at": F.current_timestamp()})

    w = (rows.writeStream.foreachBatch(lambda df, batch_id: write_batch_partition(df, sink_dir, batch_id))
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


MANIFESTS, SNAPSHOTS = "manifests", "data"


def commit_snapshot(df: DataFrame, snapshots_dir: str, snapshot_id: str, fmt: str = "parquet") -> str:
    """Land one full snapshot: its files under ``data/<id>``, then a manifest that commits it.

    Ids must sort in the order of the snapshots (e.g. a date).  A snapshot is
    seen only once its manifest exists, whatever the number of its files.
    """
    spark = df.sparkSession
    root = snapshots_dir.rstrip("/")
    if not snapshot_id or not all(c.isalnum() or c in "-_." for c in snapshot_id):
        raise ValueError(f"snapshot id {snapshot_id!r}: letters, digits, '-', '_' and '.' only")
    path = f"{root}/{SNAPSHOTS}/{snapshot_id}"
    df.write.format(fmt).save(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFESTS}/{snapshot_id}.txt")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    hidden = jvm.org.apache.hadoop.fs.Path(f"{root}/{MANIFESTS}/.{snapshot_id}.tmp")
    out = fs.create(hidden, True)
    out.write(bytearray(snapshot_id.encode("utf-8")))
    out.close()
    if not fs.rename(hidden, target):
        raise OSError(f"snapshot {snapshot_id} is already committed")
    return path


def _manifests(spark: SparkSession, snapshots_dir: str) -> list[str]:
    """Ids of all committed snapshots, in order."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{snapshots_dir.rstrip('/')}/{MANIFESTS}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n[:-len(".txt")] for n in names if n.endswith(".txt") and not n.startswith("."))


def capture_snapshot_changes(spark: SparkSession, snapshots_dir: str, schema: T.StructType, key: str,
                             sink_dir: str, checkpoint: str, fmt: str = "parquet",
                             trigger: str | None = "1 minute") -> StreamingQuery:
    """Changes between successive full snapshots (``commit_snapshot``), exactly once.

    The stream reads the manifests, a few bytes each, so a batch is a set of
    complete snapshots however large they are.  Each is diffed against the
    committed snapshot before it in id order (``operators.cdc.snapshot_diff``:
    INSERT, DELETE, and DELETE+INSERT flagged ``cdc_is_update``; the first one
    is all INSERT) and its changes are written to
    ``batch_id=N/snapshot_id=<id>``.  Everything follows from the manifests, so
    a replay rewrites the same output.  Committed snapshots are read in place:
    keep the one before the oldest snapshot that is still to be captured.  A
    snapshot that is committed with an id below one already captured raises.
    """
    from wardline.operators.cdc import snapshot_diff

    root = snapshots_dir.rstrip("/")
    captured = f"{checkpoint.rstrip('/')}-captured"

    def read(snapshot_id: str) -> DataFrame:
        return spark.read.schema(schema).format(fmt).load(f"{root}/{SNAPSHOTS}/{snapshot_id}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        new = sorted(r.value for r in batch.collect())  # one short row per snapshot
        known = _manifests(spark, root)
        newest = _newest_before(spark, captured, batch_id)
        if newest is not None and new and new[0] < newest:
            raise ValueError(f"snapshot {new[0]} was committed after {newest} had been captured")
        for snapshot_id in new:
            before = [k for k in known if k < snapshot_id]
            previous = read(before[-1]) if before else spark.createDataFrame([], schema)
            changes = (snapshot_diff(previous, read(snapshot_id), key)
                       .withColumn("_captured_at", F.current_timestamp()))
            (changes.hint("rebalance").write.mode("overwrite")
             .parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}/snapshot_id={snapshot_id}"))
        if new:
            _record(spark, captured, batch_id, new[-1])

    rows = (spark.readStream.schema("value string").format("text").option("wholetext", "true")
            .load(f"{root}/{MANIFESTS}"))
    w = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def _record(spark: SparkSession, folder: str, batch_id: int, snapshot_id: str) -> None:
    """Note the newest snapshot of a batch (a replay writes the same note)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{folder}/{batch_id:09d}={snapshot_id}")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def _newest_before(spark: SparkSession, folder: str, batch_id: int) -> str | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    notes = [st.getPath().getName().split("=", 1) for st in fs.listStatus(p)] if fs.exists(p) else []
    ids = [s for n, s in notes if int(n) < batch_id]
    return max(ids) if ids else None
