"""Summarize the final (AQE) physical plans of key queries over loaded raw tables.

Usage: python tools/plan_report.py [sf_dir]  -> markdown on stdout
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardline.operators import quality as Q  # noqa: E402
from wardline.plans import analyses as A  # noqa: E402
from wardline.plans.graph import ModelGraph  # noqa: E402
from wardline.plans.load import publish_raw  # noqa: E402
from wardline.session import get_session  # noqa: E402
from wardline.sources.testdata import raw_from_testdata  # noqa: E402

KEYS = {
    "int_encounters_enriched": lambda g: g.int_encounters_enriched,
    "int_inpatient_stays": lambda g: g.int_inpatient_stays,
    "int_patient_condition_summary": lambda g: g.int_patient_condition_summary,
    "dim_patients": lambda g: g.dim_patients,
    "fct_encounters": lambda g: g.fct_encounters,
    "fct_readmissions": lambda g: g.fct_readmissions,
    "mart_organization_kpis": lambda g: g.mart_organization_kpis,
    "mart_high_utilizers": lambda g: g.mart_high_utilizers,
    "readmission_by_age_band": lambda g: A.readmission_by_age_band(g.fct_readmissions),
    "readmission_code_share": lambda g: A.readmission_code_share(g.fct_readmissions),
    "dq_seed_coverage": lambda g: Q.seed_coverage(g.fct_encounters, g.seed_planned),
    "dq_relationships(stg_encounters)": lambda g: Q.relationships(g.stg_encounters, "patient_id",
                                                                  g.stg_patients, "patient_id"),
}


def summarize(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan().toString()
    jvm = df.sparkSession.sparkContext._jvm
    formatted = qe.explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    shuffles = re.findall(r"Exchange (hashpartitioning\([^)]*\)|rangepartitioning\([^)]*\)|SinglePartition)", plan)
    return {
        "shuffles": [re.sub(r"#\d+", "", s).replace("hashpartitioning", "hash").split(", ")[0] + ")"
                     if s.startswith("hash") else s for s in shuffles],
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted({m for m in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", plan)}),
        "windows": plan.count("Window ["),
        "pushed": sorted({re.sub(r"#\d+", "", p) for p in re.findall(r"PushedFilters: \[([^\]]+)\]", plan)
                          if "EqualTo" in p or "In(" in p}),
        "scan_cols": [len(re.findall(r"[a-z_]+:", m)) for m in re.findall(r"ReadSchema: struct<(.*)>", formatted)],
        "cartesian": "CartesianProduct" in plan or "NestedLoopJoin" in plan,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=8)
    raw = publish_raw(raw_from_testdata(spark, sf_dir), tempfile.mkdtemp(prefix="plans-"))
    g = ModelGraph(spark, raw, as_of="2024-01-01")
    print(f"| query | shuffles (final plan) | broadcasts | joins | windows | pushed equality filters | columns read per scan |")
    print("|---|---|---|---|---|---|---|")
    for k, fn in KEYS.items():
        s = summarize(fn(g))
        assert not s["cartesian"], k
        print(f"| {k} | {', '.join(s['shuffles']) or '-'} | {s['broadcasts']} | {', '.join(s['joins']) or '-'} | "
              f"{s['windows']} | {'; '.join(s['pushed']) or '-'} | {s['scan_cols']} |")
    spark.stop()


if __name__ == "__main__":
    main()
