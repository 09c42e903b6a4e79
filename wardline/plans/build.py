"""Full warehouse build: marts materialized as tables, then the quality suite.

Later marts read the tables written before them (as a table
materialization would), which cuts lineage at every level: a lost
executor only recomputes from the last written table.  The readmission
fact is derived from the written encounter fact, so the encounters x
patients join runs once.  Models that do not depend on each other are
submitted as concurrent Spark jobs from a small thread pool (like a model
runner's ``threads`` setting), level by level; the scheduler shares the
executors between them, and each check starts as soon as what it reads
exists.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from wardline.operators import intermediate as I
from wardline.operators import marts as M
from wardline.operators import quality as Q
from wardline.plans.checks import WAREHOUSE_CHECKS
from wardline.plans.graph import ModelGraph
from wardline.plans.sinks import read_table, write_table

PARTITIONING = {"fct_encounters": "encounter_year"}
ACTIVITY = "_organization_activity_stats"  # internal intermediate table
DEFAULT_THREADS = 6


def _run_level(pool: ThreadPoolExecutor, jobs: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    futures = {name: pool.submit(fn) for name, fn in jobs.items()}
    return {name: f.result() for name, f in futures.items()}


LEVELS = (("dim_patients", "dim_organizations", "fct_encounters"),
          ("fct_readmissions",),
          ("mart_organization_kpis", "mart_high_utilizers"))


def build_warehouse(g: ModelGraph, root: str, threads: int = DEFAULT_THREADS,
                    side_jobs: dict[str, Callable[[], object]] | None = None,
                    after_level: Callable[[int, dict[str, DataFrame], ThreadPoolExecutor], list] | None = None
                    ) -> dict[str, DataFrame]:
    """Write the six marts under ``root``; return them as read back.

    ``side_jobs`` start with the first level (e.g. checks on views);
    ``after_level(i, built, pool)`` may submit more work once level ``i``
    is written and returns futures to wait for.
    """
    spark = g.spark

    def publish(name: str, df_fn: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
        def run() -> DataFrame:
            write_table(df_fn(), root, name, partition_by=PARTITIONING.get(name))
            return read_table(spark, root, name)
        return run

    built: dict[str, DataFrame] = {}
    pending: list = []
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        # The encounter fact holds every column the stay sequencing needs, so
        # the readmission fact is derived from the written table: the
        # encounters x patients join runs once, not once per fact.
        first = {
            "fct_encounters": publish("fct_encounters", lambda: g.fct_encounters),
            "dim_patients": publish("dim_patients", lambda: g.dim_patients),
            "dim_organizations": publish("dim_organizations", lambda: g.dim_organizations),
        }
        # the marts are submitted before side work: the default FIFO scheduler
        # serves jobs in submission order, and the marts are the critical path
        futures = {name: pool.submit(fn) for name, fn in first.items()}
        pending += [pool.submit(v) for v in (side_jobs or {}).values()]
        built.update({name: f.result() for name, f in futures.items()})
        if after_level:
            pending += after_level(0, dict(built), pool)
        enc = built["fct_encounters"]
        # alongside the readmission fact, the organization activity aggregate
        # (it reads only the encounter fact); the KPI mart then joins small tables
        level1 = _run_level(pool, {
            "fct_readmissions": publish("fct_readmissions", lambda: M.fct_readmissions(
                I.int_inpatient_stays(enc), built["dim_patients"], g.seed_planned)),
            ACTIVITY: publish(ACTIVITY, lambda: M.organization_activity_stats(enc)),
        })
        activity = level1.pop(ACTIVITY)
        built.update(level1)
        if after_level:
            pending += after_level(1, dict(built), pool)
        readm = built["fct_readmissions"]
        built.update(_run_level(pool, {
            "mart_organization_kpis": publish("mart_organization_kpis", lambda: M.mart_organization_kpis(
                readm, None, built["dim_organizations"], activity=activity)),
            "mart_high_utilizers": publish("mart_high_utilizers", lambda: M.mart_high_utilizers(
                readm, built["dim_patients"])),
        }))
        if after_level:
            pending += after_level(2, dict(built), pool)
        for f in pending:
            f.result()
    return built


def resolver(g: ModelGraph, built: dict[str, DataFrame], views: Q.Resolver | None = None):
    """Models by name: built tables first, checkpointed views of the graph otherwise."""
    views = views or Q.checkpointed(g.model, Q.columns_needed(WAREHOUSE_CHECKS))
    return lambda name: built[name] if name in built else views(name)


BUILT_MODELS = ("dim_patients", "dim_organizations", "fct_encounters", "fct_readmissions",
                "mart_organization_kpis", "mart_high_utilizers")


def build_and_test(g: ModelGraph, root: str, threads: int = DEFAULT_THREADS,
                   checks: list[Q.Check] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build the marts and run the check suite (default: the 56 warehouse checks).

    Each check runs as soon as the relations it reads exist: checks on views
    (staging, seed) alongside the first level, checks on first-level marts
    alongside the second level, the rest at the end.
    """
    checks = checks or WAREHOUSE_CHECKS
    # staging views over Parquet raw tables are cheap column-pruned scans;
    # derived or text-parsed raw relations are materialized once instead
    views = Q.checkpointed(g.model, Q.columns_needed(checks),
                           enabled=not getattr(g.raw, "table_backed", False))
    counts: dict[str, int] = {}
    lock = threading.Lock()

    def ready_after(level: int | None) -> list[Q.Check]:
        avail = set() if level is None else {m for lv in LEVELS[:level + 1] for m in lv}
        prev = set() if level is None or level == 0 else {m for lv in LEVELS[:level] for m in lv}
        out = []
        for c in checks:
            marts = Q.models_of(c) & set(BUILT_MODELS)
            if level is None and not marts:
                out.append(c)
            elif level is not None and marts and marts <= avail and not marts <= prev:
                out.append(c)
        return out

    def run(group: list[Q.Check], built: dict[str, DataFrame]) -> None:
        got = Q.collect_failure_counts(group, resolver(g, built, views))
        with lock:
            counts.update(got)

    def after_level(level: int, built: dict[str, DataFrame], pool: ThreadPoolExecutor) -> list:
        group = ready_after(level)
        return [pool.submit(run, group, built)] if group else []

    build_warehouse(g, root, threads=threads, side_jobs={"view_checks": lambda: run(ready_after(None), {})},
                    after_level=after_level)
    built = {n: read_table(g.spark, root, n) for n in BUILT_MODELS}
    missing = [c.name for c in checks if c.name not in counts]
    if missing:
        raise RuntimeError(f"checks not run: {missing}")
    return built, Q.run_checks(g.spark, checks, None, counts=counts)
