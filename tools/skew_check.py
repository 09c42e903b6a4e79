"""Skew drill: one patient holds a third of all encounters.

Builds a skewed variant of the raw encounters (every third encounter is
re-assigned to one patient), then computes the readmission fact and reports
wall time and the largest task (from the event log in a scratch folder).

Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from wardline.plans.graph import ModelGraph  # noqa: E402
from wardline.session import get_session  # noqa: E402
from wardline.sources.catalog import RawTables  # noqa: E402
from wardline.sources.testdata import raw_from_testdata  # noqa: E402


def max_task_records(ev_dir: str, group: str) -> int:
    import zstandard
    d = max(glob.glob(f"{ev_dir}/*"), key=os.path.getmtime)
    jobs, best = set(), 0
    for f in sorted(glob.glob(f"{d}/events_*")):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        stage_job = {}
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.jobGroup.id") == group:
                jobs.add(e["Job ID"])
                for s in e["Stage IDs"]:
                    stage_job[s] = e["Job ID"]
            if e["Event"] == "SparkListenerTaskEnd" and e.get("Stage ID") in stage_job:
                m = e.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                best = max(best, recs)
    return best


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ev = tempfile.mkdtemp(prefix="skew-events-")
    # coalescing is off so that task sizes show the partitioning itself (at this
    # scale AQE would otherwise merge every shuffle into one or two tasks)
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{ev}",
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    base = raw_from_testdata(spark, sf_dir)
    enc = base["encounters"]
    hot = enc.withColumn("patient", F.when(F.col("id").cast("long") % 3 == 0, F.lit("1"))
                         .otherwise(F.col("patient")))
    raw = RawTables.from_frames({**{n: base[n] for n in base}, "encounters": hot})
    stays = ModelGraph(spark, raw).stg_encounters.filter(F.col("encounter_class") == "inpatient")
    largest = stays.groupBy("patient_id").count().agg(F.max("count")).first()[0]
    print("largest patient group (inpatient):", largest)
    spark.sparkContext.setJobGroup("stays", "stays")
    t = time.perf_counter()
    rows = ModelGraph(spark, raw, as_of="2024-01-01").fct_readmissions.collect()
    took = round(time.perf_counter() - t, 2)
    # a hot organization: a third of all encounters in one organization
    hot_org = enc.withColumn("organization", F.when(F.col("id").cast("long") % 3 == 1, F.lit("1"))
                             .otherwise(F.col("organization")))
    raw_org = RawTables.from_frames({**{n: base[n] for n in base}, "encounters": hot_org})
    spark.sparkContext.setJobGroup("org", "org")
    kpis = ModelGraph(spark, raw_org, as_of="2024-01-01").mart_organization_kpis.collect()
    spark.sparkContext.setJobGroup("", "")
    spark.stop()
    print(f"{len(rows)} stays in {took} s, largest task read {max_task_records(ev, 'stays')} shuffled records")
    top = max(kpis, key=lambda r: r["total_encounters"] or 0)
    print(f"hot organization: {top['total_encounters']} encounters; largest task of the KPI mart read "
          f"{max_task_records(ev, 'org')} shuffled records")


if __name__ == "__main__":
    main()
