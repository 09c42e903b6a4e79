"""Exact distinct patients per organization as state that merges.

Patients get dense numbers from a *dictionary*; the patients of an organization
are a *bitmap* over these numbers, cut into buckets of 64: a row holds the bits of
one bucket as a long, so there are never more rows than pairs, also where many
organizations each have a few patients all over the dictionary.  Both are tables
of parts by hash, and each part is a list of versions, one per batch that
changed it:

* a dictionary version holds the patients that were new in that batch;
* a bitmap version holds the bits of the (organization, bucket) pairs that
  got new ones.  Versions of a pair are merged by OR, so their order is of no matter.

A batch reads the parts of the dictionary that its patients hash to and the
parts of the bitmaps that its (organization, bucket) pairs hash to, and of
the latter only its own pairs; no other state.  A part that has collected
``merge_at`` versions is written as a whole with the next batch that
touches it, and its list starts anew.

A manifest per batch names the versions of every part.  Batch N reads the
newest manifest before N and writes only under ``batch_id=N``, so a replay
does the same work with the same result; what no manifest since names any more is removed
once the batch that replaced it is committed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Parts of the dictionary and of the bitmaps: the setting, read when a state begins, and its default.  A
#: part should hold a few hundred megabytes at most.
PARTS_CONF = "wardline.distinct.parts"
PARTS = "8,16"
MERGE_AT = 16

DICTIONARY = "patient_id string, code long"
BITMAPS = "organization_id string, bucket long, bits long, added long"
BUCKET = 64  # numbers per row of bitmaps: the bits of a long


class Manifest:
    """Versions of the parts after a batch: part -> batch ids, and how many numbers each dictionary part has given."""

    def __init__(self, parts: tuple[int, int], dictionary: dict | None = None, bitmaps: dict | None = None,
                 given: list[int] | None = None):
        self.parts = parts
        self.dictionary = {int(k): v for k, v in (dictionary or {}).items()}
        self.bitmaps = {int(k): v for k, v in (bitmaps or {}).items()}
        self.given = given or [0] * parts[0]

    def files(self) -> set[tuple[str, int, int]]:
        """(table, version, part) of everything that the manifest names."""
        return {(t, v, p) for t, lists in (("dictionary", self.dictionary), ("bitmaps", self.bitmaps))
                for p, versions in lists.items() for v in versions}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _manifests(spark: SparkSession, root: str) -> list[int]:
    fs, folder, _ = _fs(spark, f"{root}/manifests")
    if not fs.exists(folder):
        return []
    names = (st.getPath().getName() for st in fs.listStatus(folder))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))


def _read(spark: SparkSession, root: str, batch_id: int) -> Manifest:
    fs, path, jvm = _fs(spark, f"{root}/manifests/{batch_id}.json")
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
    try:
        doc = json.loads(reader.readLine())
    finally:
        reader.close()
    if doc.get("bucket") != BUCKET:
        raise ValueError(f"the state in {root} has bitmaps of another layout; begin a new one")
    return Manifest(tuple(doc["parts"]), doc["dictionary"], doc["bitmaps"], doc["given"])


def _write(spark: SparkSession, root: str, batch_id: int, m: Manifest) -> None:
    """The manifest appears whole: written under another name, then renamed over what a first attempt left."""
    fs, path, jvm = _fs(spark, f"{root}/manifests/{batch_id}.json")
    tmp = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps({"parts": m.parts, "dictionary": m.dictionary, "bitmaps": m.bitmaps,
                                    "given": m.given, "bucket": BUCKET}).encode()))
    out.close()
    fs.delete(path, False)
    if not fs.rename(tmp, path):
        raise OSError(f"could not write the manifest of batch {batch_id} in {root}")


def _forget(spark: SparkSession, root: str, batch_id: int) -> None:
    """Remove the manifests before the one that ``batch_id`` reads, and the parts that only they name."""
    earlier = [b for b in _manifests(spark, root) if b < batch_id]
    if len(earlier) < 2:
        return
    kept = _read(spark, root, earlier[-1]).files()
    for b in earlier[:-1]:
        for table, version, part in _read(spark, root, b).files() - kept:
            fs, path, _ = _fs(spark, f"{root}/{table}/batch_id={version}/part={part}")
            fs.delete(path, True)
        fs, path, _ = _fs(spark, f"{root}/manifests/{b}.json")
        fs.delete(path, False)


def part_of(parts: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")


def read_parts(spark: SparkSession, root: str, table: str, schema: str, versions: dict[int, list[int]],
               parts: list[int]) -> DataFrame:
    """The rows of the named parts in all their versions, with the column ``part``; other folders are not listed."""
    paths = [f"{root}/{table}/batch_id={v}/part={p}" for p in parts for v in versions.get(p, [])]
    if not paths:
        return spark.createDataFrame([], f"{schema}, part int")
    rows = spark.read.schema(f"{schema}, part int").option("basePath", f"{root}/{table}").parquet(*paths)
    return rows.select(*spark.createDataFrame([], schema).columns, "part")


def _put(rows: DataFrame, root: str, table: str, batch_id: int) -> None:
    rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{root}/{table}/batch_id={batch_id}")


def _grown(versions: dict[int, list[int]], touched: list[int], merged: list[int], batch_id: int) -> dict[int, list[int]]:
    return versions | {p: [batch_id] if p in merged else versions.get(p, []) + [batch_id] for p in touched}


def add_pairs(spark: SparkSession, pairs: DataFrame, batch_id: int, root: str, merge_at: int = MERGE_AT,
              parts: tuple[int, int] | None = None) -> DataFrame:
    """Add the (organization_id, patient_id) of a batch; organization_id and how many of its patients are new."""
    parts = parts or tuple(int(n) for n in spark.conf.get(PARTS_CONF, PARTS).split(","))
    _forget(spark, root, batch_id)
    earlier = [b for b in _manifests(spark, root) if b < batch_id]
    m = _read(spark, root, earlier[-1]) if earlier else Manifest(parts)
    given = list(m.given)
    pairs = pairs.where("organization_id is not null and patient_id is not null").select(
        "organization_id", "patient_id").distinct().persist()
    try:
        # numbers: those that are known, and new ones side by side for the patients of one organization
        people = pairs.groupBy("patient_id").agg(F.min("organization_id").alias("first_at")).withColumn(
            "part", part_of(m.parts[0], "patient_id"))
        touched = sorted(r.part for r in people.select("part").distinct().collect())
        merged = [p for p in touched if merge_at and len(m.dictionary.get(p, [])) >= merge_at]
        known = read_parts(spark, root, "dictionary", DICTIONARY, m.dictionary, touched)
        place = F.row_number().over(Window.partitionBy("part").orderBy("first_at", "patient_id")) - 1
        before = F.element_at(F.array(*[F.lit(n).cast("long") for n in given]), F.col("part") + 1)
        fresh = (people.join(known.select("patient_id"), "patient_id", "left_anti")
                 .select("patient_id", ((place + before) * m.parts[0] + F.col("part")).alias("code"), "part"))
        whole = known.where(F.col("part").isin(merged)) if merged else known.limit(0)
        _put(fresh.unionByName(whole), root, "dictionary", batch_id)
        dictionary = _grown(m.dictionary, _written(spark, root, "dictionary", batch_id), merged, batch_id)
        now = read_parts(spark, root, "dictionary", DICTIONARY, dictionary, touched)
        for r in now.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect():
            given[r.part] = r.n
        # bits of the batch, and those that were there
        bit = F.expr(f"shiftleft(1L, cast(code % {BUCKET} as int))")
        bits = (pairs.join(now.select("patient_id", "code"), "patient_id")
                .groupBy("organization_id", F.expr(f"code div {BUCKET}").alias("bucket"))
                .agg(F.bit_or(bit).alias("bits"))
                .withColumn("part", part_of(m.parts[1], "organization_id", "bucket")).persist())
        try:
            slots = sorted(r.part for r in bits.select("part").distinct().collect())
            joined = [p for p in slots if merge_at and len(m.bitmaps.get(p, [])) >= merge_at]
            key = ["organization_id", "bucket"]
            rest = read_parts(spark, root, "bitmaps", BITMAPS, m.bitmaps, [p for p in slots if p not in joined])
            olds = rest.join(bits.select(*key), key, "left_semi").unionByName(
                read_parts(spark, root, "bitmaps", BITMAPS, m.bitmaps, joined))
            both = bits.select(*key, "bits", "part", F.lit(True).alias("new")).unionByName(
                olds.select(*key, "bits", "part", F.lit(False).alias("new")))
            old = F.bit_or(F.when(F.col("new"), F.lit(0).cast("long")).otherwise(F.col("bits")))
            after = both.groupBy(*key, "part").agg(
                F.bit_or("bits").alias("bits"), (F.bit_count(F.bit_or("bits")) - F.bit_count(old)).cast("long").alias("added"))
            _put(after.where((F.col("added") > 0) | F.col("part").isin(joined)) if joined else after.where("added > 0"),
                 root, "bitmaps", batch_id)
        finally:
            bits.unpersist()
    finally:
        pairs.unpersist()
    changed = _written(spark, root, "bitmaps", batch_id)
    _write(spark, root, batch_id, Manifest(m.parts, dictionary, _grown(m.bitmaps, changed, joined, batch_id), given))
    return (read_parts(spark, root, "bitmaps", BITMAPS, {p: [batch_id] for p in changed}, changed)
            .groupBy("organization_id").agg(F.sum("added").alias("distinct_patients")))


def _written(spark: SparkSession, root: str, table: str, batch_id: int) -> list[int]:
    """The parts that a batch has written."""
    fs, path, _ = _fs(spark, f"{root}/{table}/batch_id={batch_id}")
    names = (st.getPath().getName() for st in fs.listStatus(path))
    return sorted(int(n[5:]) for n in names if n.startswith("part="))
