import pytest
from wardline.__main__ import main
from pyspark.sql import functions as F

from wardline.plans.landing import land_extract
from wardline.plans.sinks import read_table
from wardline.registry import graph

from conftest import SF_SMALL


def test_load_then_build_reports_planted_failures(spark, tmp_dir):
    g = graph(spark, SF_SMALL)
    src = land_extract(spark, {t: g.raw[t] for t in ("patients", "encounters", "conditions", "medications",
                                                    "organizations")},
                       gz=frozenset({"encounters"}), header_only=("supplies",))
    with pytest.raises(FileNotFoundError):  # every raw table, unless they are named
        main(["load", "--src", src, "--dst", f"{tmp_dir}/raw"])
    assert main(["load", "--src", src, "--dst", f"{tmp_dir}/raw", "--tables",
                 "patients,encounters,conditions,medications,organizations,supplies"]) == 0
    # the mapped data plants orphans, so error-severity checks fail: exit code 1
    assert main(["build", "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/marts", "--as-of", "2024-01-01"]) == 1
    kpis = read_table(spark, f"{tmp_dir}/marts", "mart_organization_kpis")
    assert kpis.count() == g.mart_organization_kpis.count()
    report = read_table(spark, f"{tmp_dir}/marts", "dq_report")
    assert report.count() == 56 and report.filter("status = 'fail'").count() == 4
    assert main(["build", "--csv", src, "--out", f"{tmp_dir}/marts2", "--as-of", "2024-01-01",
                 "--suite", "local"]) == 1
    # a seed file loaded by name gives the same marts as the built-in rows
    from wardline.sources.seed import PLANNED_CLASSIFICATION
    import os
    os.makedirs(f"{tmp_dir}/seed")
    with open(f"{tmp_dir}/seed/seed.csv", "w") as f:
        f.write("encounter_code,encounter_label,is_planned,classification_rationale\n")
        f.writelines(f"{c},{lab},{str(p).lower()},{why}\n" for c, lab, p, why in PLANNED_CLASSIFICATION)
    assert main(["build", "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/marts3", "--as-of", "2024-01-01",
                 "--seed", f"{tmp_dir}/seed"]) == 1
    assert sorted(map(tuple, read_table(spark, f"{tmp_dir}/marts3", "mart_organization_kpis").collect())) == \
        sorted(map(tuple, kpis.collect()))
    # the suite alone on the built marts; checks of one clean model pass
    assert main(["test", "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/marts"]) == 1
    assert main(["test", "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/marts",
                 "--model", "mart_high_utilizers"]) == 0


def test_built_tables_equal_the_model_graph(spark, tmp_dir):
    from wardline.plans.build import build_and_test
    from wardline.plans.graph import ModelGraph
    from wardline.plans.load import publish_raw
    from wardline.sources.testdata import raw_from_testdata
    raw = publish_raw(raw_from_testdata(spark, SF_SMALL), f"{tmp_dir}/raw")
    g = ModelGraph(spark, raw, as_of="2024-01-01")
    built, report = build_and_test(g, f"{tmp_dir}/marts")
    assert report.count() == 56
    for name, df in built.items():
        cols = g.model(name).columns
        a = sorted(map(str, map(tuple, df.select(*cols).collect())))
        b = sorted(map(str, map(tuple, g.model(name).collect())))
        assert a == b, name


def test_realtime_command_drains_and_publishes(spark, tmp_dir):
    from wardline.plans.landing import land_extract
    g = graph(spark, SF_SMALL)
    half = F.pmod(F.xxhash64("id"), F.lit(2)) == 0  # one half is batch-loaded, the other lands
    src = land_extract(spark, {t: g.raw[t].filter(half) if t == "encounters" else g.raw[t]
                               for t in ("patients", "encounters", "conditions", "medications", "organizations")})
    assert main(["load", "--src", src, "--dst", f"{tmp_dir}/raw", "--tables",
                 "patients,encounters,conditions,medications,organizations"]) == 0
    g.raw["encounters"].filter(~half).repartitionByRange(3, "id").write.parquet(f"{tmp_dir}/landing")
    assert main(["realtime", "--raw", f"{tmp_dir}/raw", "--landing", f"{tmp_dir}/landing",
                 "--out", f"{tmp_dir}/rt", "--checkpoint", f"{tmp_dir}/ckpt", "--trigger", "availableNow"]) == 0
    mart = read_table(spark, f"{tmp_dir}/rt", "mart_organization_kpis_rt")
    got = {r["organization_id"]: r["total_encounters"] for r in mart.collect()}
    want = {r["organization_id"]: r["total_encounters"] for r in g.mart_organization_kpis.collect()}
    assert got == want
