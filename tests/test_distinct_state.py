"""Distinct patients by dictionary and bitmaps equal sets, batch by batch."""

import json
import os
import random

from wardline.streaming import distinct_state as D


def _batches(seed, batches=7, organizations=6, patients=400):
    rng = random.Random(seed)
    out = []
    for _ in range(batches):
        rows = [(f"o{rng.randrange(organizations)}", f"p{rng.randrange(patients)}") for _ in range(rng.randrange(1, 150))]
        out.append(rows + rows[:3] + [("hot", f"p{rng.randrange(patients)}") for _ in range(60)])
    return out + [[(None, "p1"), ("o1", None)], [("o1", "p1")], []]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1) for r in rows], "organization_id string, patient_id string, bits int")


def test_new_patients_of_each_batch_equal_sets(spark, tmp_dir):
    for merge_at in (0, 2):
        seen, root = set(), f"{tmp_dir}/state{merge_at}"
        for i, rows in enumerate(_batches(merge_at + 1)):
            for _ in range(2 if i in (0, 3, 4) else 1):  # a replay gives the same
                got = {r.organization_id: r.distinct_patients
                       for r in D.add_pairs(spark, _frame(spark, rows), i - 1, root, merge_at, (3, 4)).collect()}
                want = {}
                for o, p in set(rows) - seen:
                    if o and p:
                        want[o] = want.get(o, 0) + 1
                assert got == want, (merge_at, i)
            seen |= set(rows)
        m = D._read(spark, root, max(D._manifests(spark, root)))
        codes = [r.code for r in D.read_parts(spark, root, "dictionary", D.DICTIONARY, m.dictionary, [0, 1, 2]).collect()]
        assert len(codes) == len(set(codes)) == sum(m.given) and max(codes) < 3 * max(m.given)
        if merge_at:
            assert max(len(v) for v in (m.dictionary | m.bitmaps).values()) <= merge_at
        kept = {f"batch_id={v}" for b in D._manifests(spark, root) for _, v, _ in D._read(spark, root, b).files()}
        assert len(D._manifests(spark, root)) == 2 and kept


def test_buckets_beyond_the_first(spark, tmp_dir):
    """More patients than a bitmap has bits; a later batch of one patient writes one version of one bitmap part."""
    many = spark.range(40_000).selectExpr("'o' as organization_id", "concat('p', id) as patient_id")
    assert D.add_pairs(spark, many, 0, tmp_dir, parts=(2, 8)).collect()[0].distinct_patients == 40_000
    more = spark.range(39_990, 40_010).selectExpr("'o' as organization_id", "concat('p', id) as patient_id")
    assert D.add_pairs(spark, more, 1, tmp_dir).collect()[0].distinct_patients == 10
    one = _frame(spark, [("x", "p77")])
    assert D.add_pairs(spark, one, 2, tmp_dir).collect()[0].distinct_patients == 1
    with open(f"{tmp_dir}/manifests/2.json") as f:
        doc = json.loads(f.read())
    assert sum(2 in v for v in doc["bitmaps"].values()) == 1 and sum(2 in v for v in doc["dictionary"].values()) == 0
    assert doc["parts"] == [2, 8] and sum(doc["given"]) == 40_010


def test_a_batch_reads_only_the_parts_it_touches(spark, tmp_dir, monkeypatch):
    rows = [(f"o{i}", f"p{i}") for i in range(300)]
    D.add_pairs(spark, _frame(spark, rows), 0, tmp_dir, parts=(16, 32))
    read, original = [], D.read_parts

    def seen(spark_, root, table, schema, versions, parts):
        out = original(spark_, root, table, schema, versions, parts)
        if versions and parts:
            read.append((table, sorted(parts)))
            assert sorted({os.path.basename(os.path.dirname(f)) for f in out.inputFiles()}) == sorted(f"part={p}" for p in parts)
        return out

    monkeypatch.setattr(D, "read_parts", seen)
    got = D.add_pairs(spark, _frame(spark, [("o7", "p7"), ("o7", "p8")]), 1, tmp_dir).collect()
    assert [(r.organization_id, r.distinct_patients) for r in got] == [("o7", 1)]
    assert all(len(parts) <= 2 for _, parts in read) and {t for t, _ in read} == {"dictionary", "bitmaps"}


def test_bitmaps_grow_with_the_pairs(spark, tmp_dir):
    """Many organizations with a few patients all over the dictionary: no row per pair that is wider than a long."""
    rows = [(f"o{i}", f"p{(i * 37 + k * 101) % 500}") for i in range(300) for k in range(3)]
    D.add_pairs(spark, _frame(spark, rows), 0, tmp_dir, parts=(2, 2))
    m = D._read(spark, tmp_dir, 0)
    kept = D.read_parts(spark, tmp_dir, "bitmaps", D.BITMAPS, m.bitmaps, sorted(m.bitmaps)).collect()
    assert len(kept) <= len(set(rows)) and all(isinstance(r.bits, int) for r in kept)
    assert sum(r.added for r in kept) == len(set(rows)) == sum((r.bits % 2 ** 64).bit_count() for r in kept)
