"""Changes between snapshots by fingerprints: only what differs is read.

A tracked snapshot is written in buckets by a hash of the key (of the whole row
for tables without one).  With it goes a tree of two levels: per bucket the number of
rows and two sums of independent 64-bit row hashes, and the same per ``FAN``
buckets.  Sums take no account of the order and, other than XOR, count copies; two buckets with
equal counts and equal 128 bits are taken as equal.  A comparison reads
the upper level, then the buckets of the parts that differ there, then the rows of the
buckets that differ, and joins those alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.cdc import multiset_diff, snapshot_diff

#: Buckets of a snapshot (about one file each; all snapshots of a table have the same) and buckets per upper row.
BUCKETS = 256
FAN = 16
#: The bucket of rows without a key, which match no row of another snapshot: it is always read.
NO_KEY = -1


def _hash(seed: int, columns: list[str]) -> Column:
    """A hash of the row; NULL is told from no value by flags, as the hash function skips it."""
    parts = [p for c in columns for p in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def commit_tracked(df: DataFrame, folder: str, snapshot_id: str, key: str | None = None, buckets: int = BUCKETS) -> None:
    """Write ``df`` as a tracked snapshot; it counts as there once its upper level is written, which is last."""
    path, columns = f"{folder.rstrip('/')}/{snapshot_id}", df.columns
    place = F.pmod(F.xxhash64(F.col(f"`{key}`")) if key else _hash(0, columns), F.lit(buckets)).cast("int")
    rows = df.withColumn("_bucket", F.when(F.col(f"`{key}`").isNull(), NO_KEY).otherwise(place) if key else place)
    rows.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{path}/data")
    spark = df.sparkSession
    df.limit(0).write.parquet(f"{path}/schema")  # an empty snapshot has no other file
    back = spark.read.schema(rows.schema).parquet(f"{path}/data")

    def total(seed: int) -> Column:
        return F.sum(_hash(seed, columns).cast("decimal(20,0)"))

    leaves = back.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b"))
    leaves.withColumn("node", F.floor(F.col("_bucket") / FAN).cast("int")).write.parquet(f"{path}/leaves")
    (spark.read.parquet(f"{path}/leaves").groupBy("node").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
     .write.parquet(f"{path}/nodes"))


def _differing(old: DataFrame, new: DataFrame, key: str) -> list[int]:
    """Values of ``key`` on one side only or with other sums; at most as many rows as buckets."""
    o = old.select(F.col(key).alias("k"), F.struct("n", "a", "b").alias("was"))
    c = new.select(F.col(key).alias("k"), F.struct("n", "a", "b").alias("now"))
    rows = o.join(c, "k", "full_outer").where(~F.col("was").eqNullSafe(F.col("now")))
    return sorted(r.k for r in rows.select("k").collect())


def changed_buckets(spark: SparkSession, folder: str, previous: str, current: str) -> list[int]:
    """The buckets in which two snapshots differ."""
    def level(name: str, snapshot_id: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{snapshot_id}/{name}")

    nodes = _differing(level("nodes", previous), level("nodes", current), "node")
    if not nodes:
        return []
    inside = F.col("node").isin(nodes)
    return _differing(level("leaves", previous).where(inside), level("leaves", current).where(inside), "_bucket")


def tracked_diff(spark: SparkSession, folder: str, previous: str, current: str, key: str | None = None) -> DataFrame:
    """``snapshot_diff`` (with a key) or ``multiset_diff`` of the buckets that differ."""
    buckets = changed_buckets(spark, folder, previous, current) + ([NO_KEY] if key else [])

    def rows(snapshot_id: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{snapshot_id}"
        schema = spark.read.parquet(f"{path}/schema").schema.add("_bucket", T.IntegerType())
        return (spark.read.schema(schema).parquet(f"{path}/data")
                .where(F.col("_bucket").isin(buckets) if buckets else F.lit(False)).drop("_bucket"))

    return snapshot_diff(rows(previous), rows(current), key) if key else multiset_diff(rows(previous), rows(current))
