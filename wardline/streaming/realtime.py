"""Near-real-time organization activity mart.

New encounter files are the trigger: no files, no micro-batch, no cost.

* ``mode="full"`` (the default) - each micro-batch recomputes the mart from
  the whole raw encounters, batch-loaded and landed.  Exact under any change
  to raw data, but every refresh reads all history.
* ``mode="incremental"`` - for append-only raw data.  State is
  per-organization running totals (counts, sums, exact decimal money) and the
  distinct patients of each organization as bitmaps over a patient dictionary
  (``distinct_state``).  A micro-batch aggregates only its own rows, reads the
  parts of dictionary and bitmaps that it touches, and adds the patients that
  are new to the previous totals (one row per organization).  State for batch N
  is written under ``batch_id=N`` and derived only from batches < N, so a
  replayed batch recomputes the same result.

Patients and organizations are read when a batch is processed, so a refresh
sees the dimensions as they are then.  Encounters whose patient is unknown do
not count (inner join), as in the batch model; incremental mode keeps them in
its state and tries them again with every later batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.functions import pct
from wardline.functions.clinical import AMOUNT
from wardline.operators.intermediate import int_encounters_enriched
from wardline.operators.marts import mart_organization_kpis_rt
from wardline.operators.staging import stg_encounters
from wardline.plans.sinks import write_table
from wardline.streaming.capture import _trigger, file_stream
from wardline.streaming.distinct_state import MERGE_AT, add_pairs

MART = "mart_organization_kpis_rt"
HISTORY = -1  # the batch-loaded rows, as a batch before the first
_MONEY = "decimal(34,6)"  # running totals of amounts
COMPACT_EVERY = MERGE_AT  # versions of a part of the distinct state before they are merged


def _enrich(raw_encounters: DataFrame, patients: DataFrame) -> DataFrame:
    return int_encounters_enriched(stg_encounters(raw_encounters), patients)


def _batch_totals(enriched: DataFrame) -> DataFrame:
    emergency = F.when(F.col("encounter_class") == "emergency", 1).otherwise(0)
    return enriched.groupBy("organization_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(emergency).cast("long").alias("emergency"),
        F.coalesce(F.sum("duration_minutes"), F.lit(0)).cast("long").alias("duration_sum"),
        F.count("duration_minutes").alias("duration_n"),
        F.coalesce(F.sum(F.col("total_claim_cost").cast(AMOUNT)), F.lit(0)).cast(_MONEY).alias("claim"),
        F.coalesce(F.sum(F.col("patient_out_of_pocket").cast(AMOUNT)), F.lit(0)).cast(_MONEY)
        .alias("oop"))


_SUM_COLS = ("n", "emergency", "duration_sum", "duration_n", "claim", "oop", "distinct_patients")


def _mart_from_totals(totals: DataFrame, organizations: DataFrame) -> DataFrame:
    o, t = organizations.alias("o"), totals.alias("t")
    n = F.col("t.n")
    return (o.join(t, F.col("o.organization_id") == F.col("t.organization_id"), "left")
            .select("o.organization_id", "o.organization_name", "o.city", "o.state",
                    n.alias("total_encounters"), F.col("t.distinct_patients").alias("distinct_patients"),
                    F.col("t.emergency").alias("emergency_encounters"),
                    pct(F.col("t.emergency"), n).alias("emergency_share_pct"),
                    F.round(F.try_divide(F.col("t.duration_sum").cast("double"),
                                         F.nullif(F.col("t.duration_n"), F.lit(0)).cast("double")), 1)
                    .alias("avg_duration_minutes"),
                    F.round(F.col("t.claim"), 2).cast("double").alias("total_claim_cost"),
                    F.round(F.col("t.oop"), 2).cast("double").alias("total_out_of_pocket"),
                    F.current_timestamp().alias("_dt_refreshed_at")))


def _read_state(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """Rows of state written by batches < ``before`` (empty when none)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return spark.createDataFrame([], schema + ", batch_id long")
    df = spark.read.schema(schema + ", batch_id long").parquet(path)
    return df.filter(F.col("batch_id") < before)


_TOTALS_SCHEMA = ("organization_id string, n long, emergency long, duration_sum long, duration_n long, "
                  f"claim {_MONEY}, oop {_MONEY}, distinct_patients long")


def apply_increment(spark: SparkSession, batch: DataFrame, batch_id: int, patients: DataFrame,
                    state_root: str, compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Fold one micro-batch into the running state; return totals after this batch.

    Encounters of earlier batches whose patient was not known then are tried
    again; those without a known patient now wait for the next batch.
    """
    rows = batch.unionByName(_read_unmatched(spark, state_root, batch.schema, batch_id))
    known = patients.select(F.col("patient_id").alias("_known"))
    (rows.filter(F.col("patient").isNotNull()).join(known, F.col("patient") == F.col("_known"), "left_anti")
     .write.mode("overwrite").parquet(f"{state_root}/unmatched/batch_id={batch_id}"))
    _drop_totals_before(spark, f"{state_root}/unmatched", batch_id - 1)
    # the batch is read by several steps below; keep it for this micro-batch only
    enriched = _enrich(rows, patients).persist()
    try:
        return _fold(spark, enriched, batch_id, state_root, compact_every)
    finally:
        enriched.unpersist()


def _read_unmatched(spark: SparkSession, state_root: str, schema: T.StructType, before: int) -> DataFrame:
    """Encounters still without a known patient after the batch before ``before``."""
    _, path, fs = _fs(spark, f"{state_root}/unmatched")
    ids = [int(st.getPath().getName().split("=", 1)[1]) for st in (fs.listStatus(path) if fs.exists(path) else [])
           if st.getPath().getName().startswith("batch_id=")]
    earlier = [i for i in ids if i < before]
    if not earlier:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{state_root}/unmatched/batch_id={max(earlier)}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _fold(spark: SparkSession, enriched: DataFrame, batch_id: int, state_root: str,
          compact_every: int = COMPACT_EVERY) -> DataFrame:
    totals_path = f"{state_root}/totals"
    first_seen = add_pairs(spark, enriched, batch_id, f"{state_root}/distinct", compact_every)
    delta = _batch_totals(enriched).join(first_seen, "organization_id", "full_outer")

    prior = _read_state(spark, totals_path, _TOTALS_SCHEMA, batch_id)
    last = prior.agg(F.max("batch_id")).scalar()
    prev = prior.filter(F.col("batch_id") == last).drop("batch_id")
    merged = prev.alias("a").join(delta.alias("b"), "organization_id", "full_outer").select(
        "organization_id",
        *[(F.coalesce(F.col(f"a.{c}"), F.lit(0)) + F.coalesce(F.col(f"b.{c}"), F.lit(0)))
          .cast(_MONEY if c in ("claim", "oop") else "long").alias(c) for c in _SUM_COLS])
    merged.write.mode("overwrite").parquet(f"{totals_path}/batch_id={batch_id}")
    _drop_totals_before(spark, totals_path, batch_id - 1)  # a replay of this batch reads batch_id - 1
    return spark.read.parquet(f"{totals_path}/batch_id={batch_id}")


def _drop_totals_before(spark: SparkSession, totals_path: str, oldest_kept: int) -> None:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(totals_path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=", 1)[1]) < oldest_kept:
            fs.delete(st.getPath(), True)


def _last_batch(spark: SparkSession, path: str) -> int | None:
    """The newest batch whose totals are complete."""
    jvm, root, fs = _fs(spark, path)
    names = (st.getPath().getName() for st in (fs.listStatus(root) if fs.exists(root) else []))
    ids = [int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id=")]
    return max((i for i in ids if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={i}/_SUCCESS"))), default=None)


Relation = DataFrame | Callable[[], DataFrame]


def _now(relation: Relation) -> DataFrame:
    return relation if isinstance(relation, DataFrame) else relation()


def organization_kpis_rt(spark: SparkSession, encounters_dir: str, schema: T.StructType,
                         patients: Relation, organizations: Relation, sink_root: str, checkpoint: str,
                         mode: str = "full", trigger: str | None = "1 minute",
                         max_files_per_trigger: int | None = None, state_root: str | None = None,
                         history: Relation | None = None) -> StreamingQuery:
    """Keep ``sink_root/mart_organization_kpis_rt`` fresh as encounter files land.

    ``patients`` (staged) and ``organizations`` are best given as functions:
    they are called for every batch, so a refresh reads what is there then.
    ``history`` gives the batch-loaded raw encounters, which count together
    with the landed ones.  The mart is filled with them before the stream
    starts; incremental mode folds them in once, as the batch before the first
    (run again if the first start was cut short before any file was taken).
    """
    if mode not in ("full", "incremental"):
        raise ValueError("mode must be 'full' or 'incremental'")
    state = state_root or f"{checkpoint.rstrip('/')}-state"

    names = [f.name for f in schema.fields]

    def publish(mart: DataFrame) -> None:
        write_table(mart, sink_root, MART, keep_versions=2)

    def full() -> DataFrame:
        rows = spark.read.schema(schema).parquet(encounters_dir)
        if history is not None:
            rows = rows.unionByName(_now(history).select(*names))
        return mart_organization_kpis_rt(_enrich(rows, _now(patients)), _now(organizations))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if mode == "full":
            publish(full())
        else:
            totals = apply_increment(spark, batch, batch_id, _now(patients), state)
            publish(_mart_from_totals(totals, _now(organizations)))

    # batch-loaded rows count from the start, before any file lands
    if history is not None and mode == "full":
        publish(full())
    elif history is not None and _last_batch(spark, f"{state}/totals") in (None, HISTORY):
        totals = apply_increment(spark, _now(history).select(*names), HISTORY, _now(patients), state)
        publish(_mart_from_totals(totals, _now(organizations)))

    stream = file_stream(spark, encounters_dir, schema, "parquet", max_files_per_trigger)
    w = stream.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()
