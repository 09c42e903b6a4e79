"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline import oracle
from wardline.operators import intermediate as I
from wardline.operators import marts as M
from wardline.operators import quality as Q
from wardline.plans import analyses as A
from wardline.plans.checks import WAREHOUSE_CHECKS, checks_of_kind
from wardline.plans.graph import ModelGraph
from wardline.session import ensure_checkpoint_dir
from wardline.sources.testdata import raw_from_testdata

AS_OF = oracle.AS_OF

Query = Callable[[SparkSession, str], DataFrame]


_GRAPHS: dict[tuple, ModelGraph] = {}


def graph(spark: SparkSession, sf_dir: str, fresh: bool = False, **kw) -> ModelGraph:
    """The model graph over the test tables in ``sf_dir`` (one per session and folder).

    The inputs are immutable, so the lazily built DataFrames are reused by
    every query of the session; ``fresh=True`` builds a new graph.  All
    timestamps are TIMESTAMP_NTZ, so results do not depend on the session
    time zone, which is left as the caller set it.
    """
    ensure_checkpoint_dir(spark)
    kw.setdefault("as_of", AS_OF)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, tuple(sorted((k, str(v)) for k, v in kw.items())))
    if fresh or key not in _GRAPHS:
        _GRAPHS[key] = ModelGraph(spark, raw_from_testdata(spark, sf_dir), **kw)
    return _GRAPHS[key]


_TABLES: dict[tuple, Callable[[str], DataFrame]] = {}


def tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Models by name over a loaded and built warehouse, made once per session and folder.

    Raw tables are published as Parquet, the marts are built from them in
    dependency order (encounters x patients is joined once), and staging models
    are column-pruned scans; so a check suite reads each model from its files.
    The build shuffles into partitions by the size of the input (``scaled``).
    """
    from wardline.plans.build import build_warehouse, resolver
    from wardline.plans.load import publish_raw
    from wardline.session import scaled, scratch_path
    from wardline.sources.testdata import input_bytes
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        root = scratch_path(spark, "warehouse")
        with scaled(spark, input_bytes(spark, sf_dir)):
            g = ModelGraph(spark, publish_raw(graph(spark, sf_dir).raw, f"{root}/raw"), as_of=AS_OF)
            built = build_warehouse(g, f"{root}/marts")
        _TABLES[key] = resolver(g, built, Q.checkpointed(g.model, Q.columns_needed(WAREHOUSE_CHECKS), enabled=False))
    return _TABLES[key]


_ENCOUNTERS: dict[tuple, DataFrame] = {}


def _organization_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The organization mart from a written encounter fact: activity and stays both read it."""
    from wardline.plans.sinks import read_table, write_table
    from wardline.session import scratch_path
    g = graph(spark, sf_dir)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _ENCOUNTERS:
        root = scratch_path(spark, "encounters")
        write_table(g.fct_encounters, root, "fct_encounters")
        _ENCOUNTERS[key] = read_table(spark, root, "fct_encounters")
    enc = _ENCOUNTERS[key]
    readmissions = M.fct_readmissions(I.int_inpatient_stays(enc), g.dim_patients, g.seed_planned)
    return M.mart_organization_kpis(readmissions, enc, g.dim_organizations)


def _q(name: str, fn: Callable[[ModelGraph], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(graph(spark, sf_dir))
    run.__name__ = name
    return run


MODEL_KEYS = (
    "stg_patients", "stg_encounters", "stg_conditions", "stg_medications", "stg_organizations",
    "int_encounters_enriched", "int_inpatient_stays", "int_patient_condition_summary",
    "dim_patients", "dim_organizations", "fct_encounters", "fct_readmissions",
    "mart_organization_kpis", "mart_high_utilizers",
)

QUERIES: dict[str, Query] = {k: _q(k, lambda g, k=k: g.model(k)) for k in MODEL_KEYS}
ORACLE: dict[str, str] = {k: oracle.model_sql(k) for k in MODEL_KEYS}

QUERIES["mart_organization_kpis"] = _organization_kpis

# aggregate building blocks of the marts
QUERIES.update({
    "organization_readmission_stats": _q("organization_readmission_stats",
                                         lambda g: M.organization_readmission_stats(g.fct_readmissions)),
    "organization_activity_stats": _q("organization_activity_stats",
                                      lambda g: M.organization_activity_stats(g.fct_encounters)),
    "patient_stay_stats": _q("patient_stay_stats", lambda g: M.patient_stay_stats(g.fct_readmissions)),
})
for _k in ("organization_readmission_stats", "organization_activity_stats", "patient_stay_stats"):
    ORACLE[_k] = oracle.model_sql(_k)

# documented analyses
QUERIES.update({
    "readmission_by_age_band": _q("readmission_by_age_band", lambda g: A.readmission_by_age_band(g.fct_readmissions)),
    "readmission_concentration": _q("readmission_concentration",
                                    lambda g: A.readmission_concentration(g.fct_readmissions)),
    "median_gap_by_code": _q("median_gap_by_code", lambda g: A.median_gap_by_code(g.fct_readmissions)),
    "readmission_code_share": _q("readmission_code_share", lambda g: A.readmission_code_share(g.fct_readmissions)),
    "readmission_rate_overall": _q("readmission_rate_overall",
                                   lambda g: A.readmission_rate_overall(g.fct_readmissions)),
    "age_band": _q("age_band", lambda g: A.encounters_by_age_band(g.int_encounters_enriched)),
    "seed_planned_codes": _q("seed_planned_codes",
                             lambda g: A.admission_code_classification(g.fct_encounters, g.seed_planned)),
})
for _k in oracle.ANALYSES_SQL:
    ORACLE[_k] = oracle.analysis_sql(_k)

#: SQL over registered views; the oracle runs it on the same names.
VIEWS_SQL = """
select p.state, s.encounter_code, count(*) as stays, count(distinct s.patient_id) as patients,
  max(s.stay_sequence) as longest_sequence, min(s.admitted_at) as first_admission
from {prefix}int_inpatient_stays s join {prefix}dim_patients p on s.patient_id = p.patient_id
group by p.state, s.encounter_code"""


def _views_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models registered as views, queried in SQL: the plan folds the views in."""
    graph(spark, sf_dir).register_views(("int_inpatient_stays", "dim_patients"), prefix="wardline_")
    return spark.sql(VIEWS_SQL.format(prefix="wardline_"))


QUERIES["views_sql"] = _views_sql
ORACLE["views_sql"] = oracle.with_ctes(VIEWS_SQL.format(prefix="").strip(), "int_inpatient_stays", "dim_patients")

# data quality: every check of one kind over the model graph, then the report
for _kind in ("unique", "not_null", "accepted_values", "relationships", "accepted_range"):
    QUERIES[f"dq_{_kind}"] = lambda spark, sf_dir, kind=_kind: Q.failures_of(
        checks_of_kind(kind), tables(spark, sf_dir))
    ORACLE[f"dq_{_kind}"] = oracle.failures_sql(checks_of_kind(_kind))

QUERIES.update({
    "dq_overlap_rate": _q("dq_overlap_rate", lambda g: Q.overlap_rate(g.fct_readmissions)),
    "dq_seed_coverage": _q("dq_seed_coverage", lambda g: Q.seed_coverage(g.fct_encounters, g.seed_planned)),
    "dq_unplanned_lte_allcause": _q("dq_unplanned_lte_allcause",
                                    lambda g: Q.unplanned_lte_allcause(g.mart_organization_kpis)),
    "dq_report": lambda spark, sf_dir: Q.run_checks(spark, WAREHOUSE_CHECKS, tables(spark, sf_dir)),
})
for _k, _name in (("dq_overlap_rate", "assert_overlap_rate_within_bounds"),
                  ("dq_seed_coverage", "assert_seed_covers_inpatient_codes"),
                  ("dq_unplanned_lte_allcause", "assert_unplanned_rate_lte_allcause")):
    ORACLE[_k] = oracle.with_ctes(oracle.SINGULAR_SQL[_name].strip(), *oracle.SINGULAR_DEPS[_name])
ORACLE["dq_report"] = oracle.report_sql(WAREHOUSE_CHECKS)


# --- sources and sinks ------------------------------------------------------------

def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardline.operators.staging import stg_patients
    from wardline.plans.landing import land_table_csv
    from wardline.sources.csv import scan_csv
    raw = graph(spark, sf_dir).raw["patients"]
    return stg_patients(scan_csv(spark, land_table_csv(spark, raw, "id", "patients")))


def _infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardline.operators.staging import stg_encounters
    from wardline.plans.landing import land_table_csv
    from wardline.sources.csv import infer_schema, load_by_name
    raw = graph(spark, sf_dir).raw["encounters"]
    folder = land_table_csv(spark, raw, "id", "encounters")
    return stg_encounters(load_by_name(spark, folder, infer_schema(spark, folder)))


def _load_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardline.operators.staging import stg_medications
    from wardline.plans.landing import land_table_csv
    from wardline.sources.csv import load_by_name
    raw = graph(spark, sf_dir).raw["medications"]
    folder = land_table_csv(spark, raw, "encounter", "medications")
    return stg_medications(load_by_name(spark, folder, raw.schema))


LOADED_TABLES = ("patients", "encounters", "conditions", "medications", "organizations", "supplies")


def _load_raw_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    from functools import reduce

    from wardline.plans.landing import land_extract
    from wardline.session import scratch_path
    from wardline.sources.csv import load_raw_all
    g = graph(spark, sf_dir)
    frames = {t: g.raw[t] for t in LOADED_TABLES if t != "supplies"}
    src = land_extract(spark, frames, gz=frozenset({"encounters", "medications"}), header_only=("supplies",))
    loaded = load_raw_all(spark, src, scratch_path(spark, "raw"), LOADED_TABLES)
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                    F.lit(len(df.columns)).alias("column_count"))
             for name, df in loaded.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _write_mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardline.plans.sinks import read_table, write_table
    from wardline.session import scratch_path
    root = scratch_path(spark, "marts")
    write_table(graph(spark, sf_dir).mart_organization_kpis, root, "mart_organization_kpis")
    return read_table(spark, root, "mart_organization_kpis")


QUERIES.update({
    "scan_csv": _scan_csv,
    "infer_schema": _infer_schema,
    "load_by_name": _load_by_name,
    "load_raw_all": _load_raw_all,
    "write_mart_table": _write_mart_table,
})
ORACLE.update({
    "scan_csv": oracle.model_sql("stg_patients"),
    "infer_schema": oracle.model_sql("stg_encounters"),
    "load_by_name": oracle.model_sql("stg_medications"),
    "load_raw_all": oracle.with_ctes(
        " union all ".join(
            f"select '{t}' as table_name, count(*) as row_count, {n} as column_count from raw_{t}"
            for t, n in (("patients", 14), ("encounters", 15), ("conditions", 6),
                         ("medications", 13), ("organizations", 7))),
        "raw_patients", "raw_encounters", "raw_conditions", "raw_medications", "raw_organizations"),
    "write_mart_table": oracle.model_sql("mart_organization_kpis"),
})


# --- change capture and streaming -------------------------------------------------

EXTRACT_CUTOFF = oracle.EXTRACT_CUTOFF


def _changed_snapshots(g: ModelGraph) -> tuple[DataFrame, DataFrame]:
    """An earlier extract of the raw encounters against today's.

    Previous (as of ``EXTRACT_CUTOFF``): encounters admitted before the
    cutoff; a stay still open at the cutoff had no stop yet.  Current: every
    encounter with its final stop, with orphans (unknown patient) purged.
    So the diff holds inserts (admitted since), updates (stop NULL -> value)
    and deletes (purged orphans), over the whole table.
    """
    raw = g.raw["encounters"]
    cutoff = F.lit(EXTRACT_CUTOFF).cast("timestamp_ntz")
    prev = raw.filter(F.col("start") < cutoff).withColumn(
        "stop", F.when(F.col("stop") < cutoff, F.col("stop")))
    patients = g.raw["patients"].select(F.col("id").alias("_pid"))
    curr = raw.join(patients, raw["patient"] == patients["_pid"], "left_semi")
    return prev, curr


def _snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardline.operators.cdc import snapshot_diff
    prev, curr = _changed_snapshots(graph(spark, sf_dir))
    return snapshot_diff(prev, curr, "id")


LANDING_BATCHES = 4


def _landing_files(spark: SparkSession) -> tuple[int, int]:
    """(files to land, files per trigger): as many files as shuffle partitions, about four batches.

    The file count follows the cluster's parallelism, so landing a large
    extract never funnels it through a fixed handful of tasks.
    """
    files = max(LANDING_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return files, max(1, files // LANDING_BATCHES)


def _encounters_cdc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardline.session import scratch_path
    from wardline.sources.testdata import raw_encounter_events
    from wardline.streaming.capture import capture_appends, encounter_stream_columns
    events = raw_encounter_events(spark, sf_dir)
    landing = scratch_path(spark, "landing-encounter-events")
    sink, ckpt = scratch_path(spark, "fct_encounters_stream"), scratch_path(spark, "ckpt")
    # capture starts on an empty landing folder, then the extract arrives in four files
    spark.createDataFrame([], events.schema).write.parquet(landing)
    q = capture_appends(spark, landing, events.schema, sink, ckpt, starting="latest", trigger="availableNow",
                        transform=lambda s: s.select(*encounter_stream_columns()))
    q.awaitTermination()
    files, per_trigger = _landing_files(spark)
    events.repartitionByRange(files, "id").write.mode("append").parquet(landing)
    q = capture_appends(spark, landing, events.schema, sink, ckpt, trigger="availableNow",
                        max_files_per_trigger=per_trigger,
                        transform=lambda s: s.select(*encounter_stream_columns()))
    q.awaitTermination()
    return spark.read.parquet(sink).drop("_captured_at", "batch_id")


def _organization_kpis_rt(mode: str) -> Query:
    """The realtime mart after patients arrive later than their encounters.

    A third of the encounters is batch-loaded, the others land in two parts;
    every second patient arrives only before the second part.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from wardline.operators.staging import stg_patients
        from wardline.plans.sinks import read_table
        from wardline.session import scratch_path
        from wardline.streaming.realtime import MART, organization_kpis_rt
        g = graph(spark, sf_dir)
        raw, people = g.raw["encounters"], g.raw["patients"]
        part, late = F.pmod(F.xxhash64("id"), F.lit(3)), F.pmod(F.xxhash64("id"), F.lit(2)) == 1
        loaded, landing = scratch_path(spark, "loaded-encounters"), scratch_path(spark, "landing-encounters")
        patients = scratch_path(spark, "loaded-patients")
        sink, ckpt = scratch_path(spark, "rt"), scratch_path(spark, "ckpt")
        raw.filter(part == 0).write.parquet(loaded)
        files, per_trigger = _landing_files(spark)
        for i in (1, 2):
            people.filter(late if i == 2 else ~late).write.mode("append").parquet(patients)
            raw.filter(part == i).repartitionByRange(files, "id").write.mode("append").parquet(landing)
            organization_kpis_rt(
                spark, landing, raw.schema, lambda: stg_patients(spark.read.parquet(patients)), g.dim_organizations,
                sink, ckpt, mode=mode, trigger="availableNow", max_files_per_trigger=2 * per_trigger,
                history=lambda: spark.read.parquet(loaded)).awaitTermination()
        return read_table(spark, sink, MART).drop("_dt_refreshed_at")
    return run


def _snapshot_change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of several files each wait when the capture starts."""
    from wardline.session import scratch_path
    from wardline.streaming.capture import capture_snapshot_changes, commit_snapshot
    prev, curr = _changed_snapshots(graph(spark, sf_dir))
    root, sink, ckpt = (scratch_path(spark, n) for n in ("snapshots", "changes", "ckpt"))
    files, _ = _landing_files(spark)
    for name, df in (("1998-04-01", prev), ("1998-12-31", curr)):
        commit_snapshot(df.repartition(files), root, name)
    capture_snapshot_changes(spark, root, prev.schema, "id", sink, ckpt, trigger="availableNow").awaitTermination()
    return spark.read.parquet(sink).drop("_captured_at", "batch_id").withColumn(
        "snapshot_id", F.col("snapshot_id").cast("string"))


def _multiset_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions have no key: what was recorded since the cutoff, less what has been resolved before it."""
    from wardline.operators.cdc import multiset_diff
    conditions = graph(spark, sf_dir).raw["conditions"].drop("encounter")
    cutoff = F.lit(EXTRACT_CUTOFF).cast("date")
    return multiset_diff(conditions.filter(F.col("start") < cutoff),
                         conditions.filter(F.col("stop").isNull() | (F.col("stop") >= cutoff)))


def _tracked_tables_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters (by id), conditions and medications (as multisets) tracked as two snapshots, compared by fingerprints."""
    from functools import reduce

    from wardline.operators.fingerprints import commit_tracked, tracked_diff
    from wardline.session import scratch_path
    raw = graph(spark, sf_dir).raw
    cutoff = F.lit(EXTRACT_CUTOFF).cast("timestamp_ntz")
    snapshots = {"encounters": (*_changed_snapshots(graph(spark, sf_dir)), "id")}
    for name in ("conditions", "medications"):
        rows = raw[name]
        snapshots[name] = (rows.filter(F.col("start") < cutoff),
                           rows.filter(F.col("stop").isNull() | (F.col("stop") >= cutoff)), None)
    parts = []
    for name, (before, after, key) in snapshots.items():
        folder = scratch_path(spark, f"tracked-{name}")
        for snapshot_id, df in (("1", before), ("2", after)):
            commit_tracked(df, folder, snapshot_id, key, buckets=32)
        changes = tracked_diff(spark, folder, "1", "2", key)
        of_row = [F.col(c).cast("string") for c in ("patient", "encounter", "code", "start", "stop")]
        parts.append(changes.select(
            F.lit(name).alias("table_name"), (F.col(key) if key else F.concat_ws("|", *of_row)).alias("row_key"), "cdc_action",
            (F.col("cdc_is_update") if key else F.lit(False)).alias("cdc_is_update"),
            (F.lit(1) if key else F.col("cdc_rows")).cast("long").alias("cdc_rows")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _ingest_raw_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wardline.session import scratch_path
    from wardline.sources.testdata import raw_encounter_events
    from wardline.streaming.ingest import TEXT_TS_OPTIONS, ingest_raw_stream
    events = raw_encounter_events(spark, sf_dir)
    landing = scratch_path(spark, "landing-json")
    files, per_trigger = _landing_files(spark)
    events.repartitionByRange(files, "id").write.options(**TEXT_TS_OPTIONS).json(landing)
    raw_dir, ckpt = scratch_path(spark, "raw-encounter-events"), scratch_path(spark, "ckpt")
    q = ingest_raw_stream(spark, landing, events.schema, raw_dir, ckpt, trigger="availableNow",
                          max_files_per_trigger=per_trigger)
    q.awaitTermination()
    return spark.read.parquet(raw_dir)


QUERIES.update({
    "snapshot_diff": _snapshot_diff,
    "encounters_cdc_append": _encounters_cdc_append,
    "organization_kpis_rt": _organization_kpis_rt("full"),
    "organization_kpis_rt_incremental": _organization_kpis_rt("incremental"),
    "snapshot_change_stream": _snapshot_change_stream,
    "multiset_diff": _multiset_diff,
    "tracked_tables_diff": _tracked_tables_diff,
    "ingest_raw_stream": _ingest_raw_stream,
})
ORACLE.update({
    "snapshot_diff": oracle.snapshot_diff_sql(),
    "encounters_cdc_append": oracle.encounter_events_sql(
        "id as encounter_id, patient as patient_id, organization as organization_id, "
        "encounterclass as encounter_class, start as started_at, total_claim_cost, "
        "'INSERT' as cdc_action, false as cdc_is_update"),
    "organization_kpis_rt": oracle.with_ctes(
        "select o.organization_id, o.organization_name, o.city, o.state, a.total_encounters, a.distinct_patients, "
        "a.emergency_encounters, a.emergency_share_pct, a.avg_duration_minutes, a.total_claim_cost, "
        "a.total_out_of_pocket from dim_organizations o "
        "left join organization_activity_stats a on o.organization_id = a.organization_id",
        "dim_organizations", "organization_activity_stats"),
    "snapshot_change_stream": oracle.snapshot_stream_sql(),
    "multiset_diff": oracle.multiset_diff_sql(),
    "tracked_tables_diff": oracle.tracked_tables_sql(),
    "ingest_raw_stream": oracle.encounter_events_sql("*"),
})
ORACLE["organization_kpis_rt_incremental"] = ORACLE["organization_kpis_rt"]
