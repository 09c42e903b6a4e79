import random

import llm_brute as B
import numpy as np

from wardline.llm import toxicity as X


def corpus(n=900, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(5, 80))]
        grade = rng.choice([0, 0, 0, 1, 2])
        for _ in range(grade * 2):
            words.insert(rng.randrange(len(words)), rng.choice(["Nasty!", "awfulness", "awfully"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if grade == 2 else 1, int(grade > 0), "x"))
    return rows, labels


def test_held_out_accuracy_and_order(spark):
    rows, labels = corpus()
    docs = B.documents(spark, rows)
    schema = "doc_id long, quality int, toxic int, grade string"
    model = X.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 3], schema))
    assert model.thresholds[0] <= model.thresholds[1]
    out = {r.doc_id: r for r in X.severity(docs, model).collect()}
    held = [x for x in labels if not x[0] % 3]
    assert np.mean([out[i].toxic == bool(t) for i, _, t, _ in held]) > 0.97
    mean = [np.mean([out[i].severity for i, q, t, _ in held if (2 - q if t else 0) == g]) for g in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]
    kept = X.keep_clean(docs, model, ["doc_id", "text"]).collect()
    assert {r.doc_id for r in kept} == {i for i, r in out.items() if not r.toxic}


def test_edges(spark):
    docs = B.documents(spark, B.EDGES)
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(1, None, None), (None, 1, 1)], [(3, 1, 1)], [(0, 1, 0), (8, 0, 1), (8, 0, 0), (99, 1, 1)]):
        model = X.fit(docs, spark.createDataFrame(labels, schema))
        out = X.severity(docs, model).collect()
        assert len(out) == len(B.EDGES) and not any(r.toxic for r in out if r.doc_id in (0, 1, 2))
    assert X.severity(B.documents(spark, []), X.Model()).collect() == []


def test_ordinal_fit_shares_weights():
    rng = np.random.default_rng(0)
    x = rng.standard_normal(4000)
    grades = (x + 0.3 * rng.logistic(size=4000) > 0).astype(int) + (x + 0.3 * rng.logistic(size=4000) > 1)
    grades = np.maximum.accumulate(np.stack([grades]), 0)[0]
    w, cuts = X.fit_ordinal(np.arange(4000), np.zeros(4000, int), x, grades, 1, 2)
    assert w[0] > 1.5 and abs(cuts[0]) < 0.4 and 0.6 < (cuts[1] - cuts[0]) / w[0] < 1.4


def test_design_matrix_is_that_of_sorted_rows():
    import pyarrow as pa

    rng = random.Random(2)
    data = [(rng.randrange(3), [rng.randrange(9) for _ in range(i % 4)], [rng.random() for _ in range(i % 4)], rng.randrange(40))
            for i in range(200)]
    parts = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.list_(pa.int32())),
                                         pa.array([r[2] for r in part], pa.list_(pa.float64())), pa.array([r[3] for r in part], pa.int64())],
                                        names=["grade", "idx", "val", "doc_id"]) for part in (data[:70], data[70:])]
    grades, rows, cols, vals = X.design(pa.Table.from_batches(parts))
    data.sort(key=lambda r: (r[3], *r[:3]))
    assert grades.tolist() == [r[0] for r in data]
    assert rows.tolist() == [i for i, r in enumerate(data) for _ in r[1]]
    assert cols.tolist() == [c for r in data for c in r[1]] and vals.tolist() == [v for r in data for v in r[2]]
