import gzip
import os

import pytest
from pyspark.sql import types as T

from wardline.sources.csv import infer_schema, load_by_name, load_raw_all, scan_csv


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
                       T.StructField("amount", T.DoubleType()), T.StructField("zip", T.StringType()),
                       T.StructField("extra", T.StringType())])


def test_load_by_name_reordered_mixed_case_quoted_and_missing(spark, tmp_dir):
    _write(f"{tmp_dir}/t/a.csv", 'Id,NAME,Amount,zip\n1,"Doe, Jane",1.5,01234\n2,,2,\n')
    _write(f"{tmp_dir}/t/b.csv.gz", 'zip,amount,id,name\n00042,3.25,3,Bob\n', gz=True)
    rows = {r["id"]: r for r in load_by_name(spark, f"{tmp_dir}/t", SCHEMA).collect()}
    assert rows["1"]["name"] == "Doe, Jane" and rows["1"]["amount"] == 1.5 and rows["1"]["zip"] == "01234"
    assert rows["2"]["name"] is None and rows["2"]["zip"] is None  # empty field -> NULL
    assert rows["3"]["zip"] == "00042" and rows["3"]["amount"] == 3.25
    assert all(r["extra"] is None for r in rows.values())  # missing column -> NULL


def test_malformed_number_aborts(spark, tmp_dir):
    _write(f"{tmp_dir}/bad/a.csv", "id,amount\n1,12x\n")
    with pytest.raises(Exception):
        load_by_name(spark, f"{tmp_dir}/bad", SCHEMA).collect()


def test_scan_is_all_strings_lower_case(spark, tmp_dir):
    _write(f"{tmp_dir}/s/a.csv", "ID,Birthdate\n007,2020-01-01\n")
    df = scan_csv(spark, f"{tmp_dir}/s")
    assert df.columns == ["id", "birthdate"] and df.first()["id"] == "007"


def test_infer_schema_keeps_ids_and_zip_as_text(spark, tmp_dir):
    _write(f"{tmp_dir}/i/a.csv", "Id,zip,amount,START\n1,01000,2.5,2020-01-01T10:00:00\n")
    sch = {f.name: f.dataType for f in infer_schema(spark, f"{tmp_dir}/i").fields}
    assert sch["id"] == T.StringType() and sch["zip"] == T.StringType()
    assert sch["amount"] == T.DoubleType() and sch["start"] == T.TimestampNTZType()


def test_load_raw_all_skips_header_only(spark, tmp_dir):
    _write(f"{tmp_dir}/src/patients.csv.gz", "Id,zip\n1,01000\n2,02000\n", gz=True)
    _write(f"{tmp_dir}/src/supplies.csv", "Date,Patient,Code\n")
    loaded = load_raw_all(spark, f"{tmp_dir}/src", f"{tmp_dir}/dst", ["patients", "supplies"])
    assert set(loaded) == {"patients"}
    assert sorted(r["zip"] for r in loaded["patients"].collect()) == ["01000", "02000"]
    with pytest.raises(FileNotFoundError):
        load_raw_all(spark, f"{tmp_dir}/src", f"{tmp_dir}/dst", ["missing"])


def test_seed_from_csv_by_name(spark, tmp_dir):
    from wardline.sources.seed import PLANNED_CLASSIFICATION, planned_classification
    lines = ["is_planned,Encounter_Code,classification_rationale,encounter_label"]
    lines += [f"{str(p).lower()},{c},\"{why}\",\"{lab}\"" for c, lab, p, why in PLANNED_CLASSIFICATION]
    _write(f"{tmp_dir}/seed/seed.csv", "\n".join(lines) + "\n")
    got = sorted(tuple(r) for r in planned_classification(spark, f"{tmp_dir}/seed").collect())
    assert got == sorted(PLANNED_CLASSIFICATION)


def test_models_over_csv_in_place_equal_test_tables(spark):
    from wardline.plans.graph import ModelGraph
    from wardline.plans.landing import land_extract
    from wardline.registry import graph
    from wardline.sources.catalog import RawTables

    from conftest import SF_SMALL
    g = graph(spark, SF_SMALL)
    folder = land_extract(spark, {t: g.raw[t] for t in ("patients", "encounters", "conditions",
                                                        "medications", "organizations")},
                          gz=frozenset({"encounters"}))
    csv_graph = ModelGraph(spark, RawTables.from_csv(spark, folder), as_of="2024-01-01")
    a = sorted(tuple(r) for r in csv_graph.mart_high_utilizers.collect())
    b = sorted(tuple(r) for r in g.mart_high_utilizers.collect())
    assert a == b


def test_malformed_value_aborts_without_ansi(spark, tmp_dir):
    _write(f"{tmp_dir}/bad2/a.csv", "id,amount\n1,2.5\n2,abc\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="cannot load column amount"):
            load_by_name(spark, f"{tmp_dir}/bad2", SCHEMA).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_inference_merges_layouts_by_name(spark, tmp_dir):
    _write(f"{tmp_dir}/m/a.csv", "id,amount,note\n1,2.5,7\n")
    _write(f"{tmp_dir}/m/b.csv", "note,id,amount\nhello,2,3.5\n")
    sch = {f.name: f.dataType for f in infer_schema(spark, f"{tmp_dir}/m").fields}
    assert sch["amount"] == T.DoubleType()
    assert sch["note"] == T.StringType()  # integer in one layout, text in the other
    rows = {r["id"]: r for r in load_by_name(spark, f"{tmp_dir}/m", infer_schema(spark, f"{tmp_dir}/m")).collect()}
    assert rows["2"]["note"] == "hello" and rows["1"]["note"] == "7" and rows["2"]["amount"] == 3.5


def test_scale_conf_sizes_partitions():
    from wardline.session import scale_conf
    conf = scale_conf(100 << 40)
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert scale_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_scan_with_a_repeated_header_name(spark, tmp_dir):
    _write(f"{tmp_dir}/dup/a.csv", "id,code,Code\n1,x,y\n")
    df = scan_csv(spark, f"{tmp_dir}/dup")
    assert [tuple(r) for r in df.collect()] == [("1", "x", "y")]
    assert df.columns == ["id", "code", "code"]


def test_nested_folders_line_breaks_and_types_that_widen_late(spark, tmp_dir):
    for i in range(9):
        _write(f"{tmp_dir}/t/y{i % 3}/part{i}.csv", f"id,amount,note\n{i},{i},plain\n")
    _write(f"{tmp_dir}/t/z/last.csv", 'id,amount,note\n9,1.5,"two\nlines, ""quoted"""\n')
    _write(f"{tmp_dir}/t/z/other.csv", "note,id\n,10\n")
    _write(f"{tmp_dir}/t/_hidden/x.csv", "id\n99\n")
    schema = infer_schema(spark, f"{tmp_dir}/t")
    assert {f.name: f.dataType for f in schema.fields}["amount"] == T.DoubleType()
    rows = {r["id"]: r for r in load_by_name(spark, f"{tmp_dir}/t", schema).collect()}
    assert len(rows) == 11 and rows["9"]["note"] == 'two\nlines, "quoted"' and rows["9"]["amount"] == 1.5
    assert rows["10"]["note"] is None and rows["3"]["amount"] == 3


def test_ambiguous_missing_and_disguised_sources_raise(spark, tmp_dir):
    _write(f"{tmp_dir}/src/orders.csv", "id\n1\n")
    _write(f"{tmp_dir}/src/orders/p.csv", "id\n2\n")
    with pytest.raises(ValueError, match="several forms"):
        load_raw_all(spark, f"{tmp_dir}/src", f"{tmp_dir}/dst", ["orders"])
    with pytest.raises(FileNotFoundError, match="nothing"):
        load_raw_all(spark, f"{tmp_dir}/src", f"{tmp_dir}/dst", ["nothing"])
    _write(f"{tmp_dir}/gz/a.csv", "id\n1\n", gz=True)
    with pytest.raises(ValueError, match="gzip"):
        scan_csv(spark, f"{tmp_dir}/gz")


def test_offsets_become_utc(spark, tmp_dir):
    _write(f"{tmp_dir}/o/a.csv", "id,at\n1,2020-01-01T00:00:00+02:00\n2,2020-01-01T00:00:00Z\n3,2020-01-01T00:00:00\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("at", T.TimestampNTZType())])
    got = {r["id"]: str(r["at"]) for r in load_by_name(spark, f"{tmp_dir}/o", schema).collect()}
    assert got == {"1": "2019-12-31 22:00:00", "2": "2020-01-01 00:00:00", "3": "2020-01-01 00:00:00"}
    assert infer_schema(spark, f"{tmp_dir}/o").fields[1].dataType == T.TimestampNTZType()


def test_reload_keeps_two_versions(spark, tmp_dir):
    _write(f"{tmp_dir}/src/orders.csv", "id\n1\n")
    for _ in range(3):
        load_raw_all(spark, f"{tmp_dir}/src", f"{tmp_dir}/dst", ["orders"])
    assert len([d for d in os.listdir(f"{tmp_dir}/dst/orders") if d.startswith("v")]) == 2


def test_counts_of_lines_are_aggregated_without_a_sort(spark, tmp_dir):
    from wardline.sources import csv as C

    for i in range(40):  # many small files in one task, some of them with a blank first line
        _write(f"{tmp_dir}/many/{i}.csv{'.gz' if i % 2 else ''}", "\n" * (i % 3) + f"id,n{i % 4},day\n{i},{i},2020-01-0{1 + i % 9}\n7,,\n", gz=i % 2 == 1)
    lines = C._text(spark, [f for f, _ in C.list_files(spark, f"{tmp_dir}/many")])
    for df in (C._facts(lines), C._counted(lines)):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "Aggregate" in plan and "SortAggregate" not in plan
    facts = {C._name(r.f).rpartition("/")[2]: r for r in C._facts(lines).collect()}
    assert all(facts[f"{i}.csv{'.gz' if i % 2 else ''}"].first == f"id,n{i % 4},day" for i in range(40))
    assert {(r.odd, r.lines) for r in facts.values()} == {(False, 3)}
    assert [(f.name, f.dataType.simpleString()) for f in infer_schema(spark, f"{tmp_dir}/many").fields if f.name != "id"] == [
        ("n0", "int"), ("day", "date"), ("n1", "int"), ("n2", "int"), ("n3", "int")]
