"""Differences by fingerprints equal full comparisons and read only the buckets that differ."""

import re

import pytest
from pyspark.sql import functions as F

from wardline.operators import fingerprints as P
from wardline.operators.cdc import multiset_diff, snapshot_diff


def _rows(df):
    return sorted(map(str, df.collect()))


def _people(spark, n=4000):
    return spark.range(n).selectExpr("concat('p', id) as id", "if(id % 7 = 0, null, 'a') as x", "if(id % 7 = 0, 'a', null) as y",
                                     "id % 5 as v")


def test_keyed_snapshots(spark, tmp_dir):
    old = _people(spark).unionByName(_people(spark, 3).withColumn("id", F.lit(None).cast("string")))
    touched = F.col("id").isin("p5", "p7")
    new = (old.where("id is null or id <> 'p9'").withColumn("v", F.when(touched, 99).otherwise(F.col("v")))
           .unionByName(_people(spark, 1).withColumn("id", F.lit("new"))))
    P.commit_tracked(old, tmp_dir, "1", "id", 64)
    P.commit_tracked(new, tmp_dir, "2", "id", 64)
    buckets = P.changed_buckets(spark, tmp_dir, "1", "2")
    assert 1 <= len(buckets) <= 4
    got = P.tracked_diff(spark, tmp_dir, "1", "2", "id")
    assert _rows(got) == _rows(snapshot_diff(old, new, "id")) and got.count() == 6 + 6
    plan = got._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert len(re.findall(r"PartitionFilters: \[[^\n]*_bucket", plan)) >= 2
    scanned = sum(spark.read.parquet(f"{tmp_dir}/{s}/data").where(F.col("_bucket").isin(buckets)).count() for s in "12")
    assert scanned < 0.1 * 2 * old.count()  # a few of 64 buckets
    P.commit_tracked(new.repartition(5), tmp_dir, "3", "id", 64)
    assert P.changed_buckets(spark, tmp_dir, "2", "3") == []
    assert P.tracked_diff(spark, tmp_dir, "2", "3", "id").where("id is not null").count() == 0  # rows without a key never match


@pytest.mark.parametrize("change", ["copies", "swap"])
def test_multisets_count_copies_and_tell_null_places_apart(spark, tmp_dir, change):
    old = _people(spark, 50).drop("id")
    new = old.unionByName(old.limit(2)) if change == "copies" else old.select(F.col("y").alias("x"), F.col("x").alias("y"), "v")
    P.commit_tracked(old, tmp_dir, "a", buckets=8)
    P.commit_tracked(new, tmp_dir, "b", buckets=8)
    assert _rows(P.tracked_diff(spark, tmp_dir, "a", "b")) == _rows(multiset_diff(old, new))


def test_empty_snapshots(spark, tmp_dir):
    none = _people(spark, 0)
    for name in "ab":
        P.commit_tracked(none, tmp_dir, name, "id")
    P.commit_tracked(_people(spark, 3), tmp_dir, "c", "id")
    assert P.tracked_diff(spark, tmp_dir, "a", "b", "id").count() == 0
    assert {r.cdc_action for r in P.tracked_diff(spark, tmp_dir, "b", "c", "id").collect()} == {"INSERT"}
