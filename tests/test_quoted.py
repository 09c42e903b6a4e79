"""Files with quoted line breaks, read in many splits, equal Spark's multi-line reader."""

import random

import pytest

from wardline.sources.csv import CSV_OPTIONS, Extract, infer_schema, load_by_name, scan_csv


def _random_csv(rng, rows):
    out = ["id,a,note"]
    for i in range(rows):
        def field():
            kind = rng.random()
            text = "".join(rng.choice(["x", "yz", "é", "\n", "\r\n", ",", '""', " "]) for _ in range(rng.randrange(12)))
            if kind < 0.3:
                return f'"{text}"'
            if kind < 0.35:
                return f'"{"long line" * rng.randrange(30)}\n{text}"'
            return rng.choice(["", "plain", "7", "two words"])
        out.append(f"{i},{field()},{field()}")
    return "\n".join(out) + rng.choice(["", "\n"])


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_multi_line_reader(spark, tmp_dir, small_splits, seed):
    rng = random.Random(seed)
    import os
    os.makedirs(f"{tmp_dir}/t")
    for n in range(2):
        with open(f"{tmp_dir}/t/f{n}.csv", "w", newline="") as f:
            f.write(_random_csv(rng, 60))
    want = spark.read.options(**{**CSV_OPTIONS, "multiLine": "true"}).csv(f"{tmp_dir}/t")
    got = scan_csv(spark, f"{tmp_dir}/t")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.rdd.getNumPartitions() > 20  # as many tasks as splits


def test_a_record_over_many_splits_and_types(spark, tmp_dir, small_splits):
    import os
    os.makedirs(f"{tmp_dir}/t")
    long = "\n".join(f"line {i}" for i in range(200))
    with open(f"{tmp_dir}/t/a.csv", "w") as f:
        f.write(f'id,n,at,note\n1,5,2020-01-01T10:00:00,"{long}"\n2,70000000000,2020-01-02T00:00:00,"a ""b"""\n\n3,,,"{long}"')
    schema = infer_schema(spark, f"{tmp_dir}/t")
    assert schema.simpleString() == "struct<id:string,n:bigint,at:timestamp_ntz,note:string>"
    rows = {r.id: r for r in load_by_name(spark, f"{tmp_dir}/t", schema).collect()}
    assert len(rows) == 3 and rows["1"].note == rows["3"].note == long and rows["2"].note == 'a "b"'
    assert rows["2"].n == 70_000_000_000 and rows["3"].n is None


def test_types_of_every_kind_and_headers_that_look_like_values(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/t")
    with open(f"{tmp_dir}/t/a.csv", "w") as f:
        f.write("i,l,d,day,at,flag,mix,none,2020,0012\n"
                "1,1,1.5,2020-01-31,2020-01-31,true,2020,,7,01\n"
                "-2,3000000000,1e3,2020-02-29,2020-02-29 01:02:03,FALSE,2020-01-01,,8,2\n"
                "3,4,.5,,,,x,,,\n")
    with open(f"{tmp_dir}/t/b.csv", "w") as f:
        f.write("i,l,d,day,at,flag,mix,none,2020,0012\n7,7,7,2021-01-01,2021-01-01T00:00:00.5,true,1,,1,1\n")
    got = {f.name: f.dataType.simpleString() for f in infer_schema(spark, f"{tmp_dir}/t").fields}
    assert got == {"i": "int", "l": "bigint", "d": "double", "day": "date", "at": "timestamp_ntz", "flag": "boolean",
                   "mix": "string", "none": "string", "2020": "int", "0012": "int"}
    extract = Extract.of(spark, f"{tmp_dir}/t", types=True)
    rows = load_by_name(spark, extract, infer_schema(spark, extract)).collect()
    assert len(rows) == 4 and {r["2020"] for r in rows} == {7, 8, None, 1}


def test_one_pass_over_the_text(spark, tmp_dir):
    """Headers, line breaks and types cost one scan of the lines, the load another."""
    import os
    os.makedirs(f"{tmp_dir}/t")
    for n in range(3):
        with open(f"{tmp_dir}/t/{n}.csv", "w") as f:
            f.write("id,v\n" + "".join(f"{i},{i}\n" for i in range(50)))
    store = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-pass", "headers and types")
    extract = Extract.of(spark, f"{tmp_dir}/t", types=True)
    before = len(store.getJobIdsForGroup("one-pass"))
    schema = infer_schema(spark, extract)
    assert len(store.getJobIdsForGroup("one-pass")) == before  # no job: the counts are there
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert schema.simpleString() == "struct<id:string,v:int>" and extract.filled
    assert load_by_name(spark, extract, schema).count() == 150
