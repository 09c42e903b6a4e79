"""Command line: ``python -m wardline <command>`` (also usable with spark-submit).

  load      CSV extract folder -> raw Parquet tables (create or replace)
  build     raw tables (Parquet root or CSV folder) -> marts + the 56 checks;
            exits 1 if an error-severity check fails (warnings are reported)
  test      the checks alone, on marts already built under --out (optionally
            only those reading --model)
  realtime  keep the organization activity mart fresh from a landing folder
"""

from __future__ import annotations

import argparse
import sys

from wardline.session import clear_scratch, get_session, scratch_count
from wardline.sources.catalog import RawTables

# The raw extract tables, in load order; `supplies` ships header-only.
ALL_RAW = ("allergies", "careplans", "conditions", "devices", "encounters", "imaging_studies",
           "immunizations", "medications", "observations", "organizations", "patients",
           "payer_transitions", "payers", "procedures", "providers", "supplies")


def _graph(spark, args):
    from wardline.plans.graph import ModelGraph
    from wardline.sources.seed import planned_classification
    seed = planned_classification(spark, args.seed) if getattr(args, "seed", None) else None
    return ModelGraph(spark, _raw(spark, args), planned=seed, as_of=args.as_of)


def _raw(spark, args) -> RawTables:
    raw = RawTables.from_csv(spark, args.csv) if args.csv else RawTables.from_tables(spark, args.raw)
    for item in getattr(args, "stream", None) or []:
        name, _, folder = item.partition("=")
        raw = raw.with_stream(name, folder)
    return raw


def cmd_load(spark, args) -> int:
    from wardline.sources.csv import load_raw_all
    names = args.tables.split(",") if args.tables else list(ALL_RAW)
    loaded = load_raw_all(spark, args.src, args.dst, names)
    for name, df in loaded.items():
        print(f"{name}: {len(df.columns)} columns")
    return 0


def cmd_build(spark, args) -> int:
    from pyspark.sql import functions as F

    from wardline.operators.quality import raise_on_errors
    from wardline.plans.build import build_and_test
    from wardline.plans.checks import LOCAL_CHECKS, WAREHOUSE_CHECKS
    g = _graph(spark, args)
    suite = LOCAL_CHECKS if args.suite == "local" else WAREHOUSE_CHECKS
    _, report = build_and_test(g, args.out, threads=args.threads, checks=suite)
    from wardline.plans.sinks import read_table, write_table
    write_table(report, args.out, "dq_report")  # one row per check, kept with the marts
    report = read_table(spark, args.out, "dq_report")
    report.orderBy(F.col("status").desc(), "check_name").show(report.count(), truncate=False)
    try:
        raise_on_errors(report)
    except AssertionError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


def cmd_test(spark, args) -> int:
    from pyspark.sql import functions as F

    from wardline.operators import quality as Q
    from wardline.plans.build import BUILT_MODELS
    from wardline.plans.checks import LOCAL_CHECKS, WAREHOUSE_CHECKS
    from wardline.plans.sinks import read_table
    g = _graph(spark, args)
    suite = LOCAL_CHECKS if args.suite == "local" else WAREHOUSE_CHECKS
    if args.model:
        suite = [c for c in suite if args.model in Q.models_of(c)]
    tables = {n: read_table(spark, args.out, n) for n in BUILT_MODELS}
    views = Q.checkpointed(g.model, Q.columns_needed(suite), enabled=not g.raw.table_backed)
    report = Q.run_checks(spark, suite, lambda n: tables[n] if n in tables else views(n)).cache()
    report.orderBy(F.col("status").desc(), "check_name").show(report.count(), truncate=False)
    try:
        Q.raise_on_errors(report)
    except AssertionError as e:
        print(e, file=sys.stderr)
        return 1
    return 0


def cmd_realtime(spark, args) -> int:
    from wardline.streaming.realtime import organization_kpis_rt
    schema = spark.read.parquet(args.landing).schema
    # dimensions and batch-loaded encounters are opened anew for every refresh
    q = organization_kpis_rt(spark, args.landing, schema, lambda: _graph(spark, args).stg_patients,
                             lambda: _graph(spark, args).dim_organizations, args.out, args.checkpoint,
                             mode=args.mode, trigger=args.trigger, history=lambda: _raw(spark, args)["encounters"])
    q.awaitTermination()
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="wardline")
    sub = p.add_subparsers(dest="cmd", required=True)
    lp = sub.add_parser("load")
    lp.add_argument("--src", required=True)
    lp.add_argument("--dst", required=True)
    lp.add_argument("--tables", default="")
    for name in ("build", "test", "realtime"):
        sp = sub.add_parser(name)
        src = sp.add_mutually_exclusive_group(required=True)
        src.add_argument("--raw", help="root of raw Parquet tables written by `load`")
        src.add_argument("--csv", help="folder of raw CSV files read in place")
        sp.add_argument("--out", required=True, help="root of the mart tables (written or read)")
        if name != "realtime":
            sp.add_argument("--stream", action="append", metavar="TABLE=FOLDER",
                            help="rows ingested by a stream that belong to raw TABLE (may be given several times)")
        sp.add_argument("--as-of", default=None, help="date for current ages (default: today)")
        sp.add_argument("--seed", default=None, help="planned-classification CSV (default: built-in rows)")
        if name == "build":
            sp.add_argument("--threads", type=int, default=6)
        if name in ("build", "test"):
            sp.add_argument("--suite", default="warehouse", choices=("warehouse", "local"))
        if name == "test":
            sp.add_argument("--model", default=None, help="only checks that read this model")
        if name == "realtime":
            sp.add_argument("--landing", required=True)
            sp.add_argument("--checkpoint", required=True)
            sp.add_argument("--mode", default="full", choices=("full", "incremental"))
            sp.add_argument("--trigger", default="1 minute")
    args = p.parse_args(argv)
    spark = get_session(app=f"wardline-{args.cmd}")
    before = scratch_count()
    try:
        return {"load": cmd_load, "build": cmd_build, "test": cmd_test,
                "realtime": cmd_realtime}[args.cmd](spark, args)
    finally:
        clear_scratch(spark, keep=before)


if __name__ == "__main__":
    sys.exit(main())
