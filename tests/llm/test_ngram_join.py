import random

import llm_brute as B
import pyarrow as pa
import pytest

from wardline.llm import ngram_join as J


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None}


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, i = [], 0
    for size in [2, 3, 5, 9, 11, 12, 13, 14, 21, 22, 23, 24, 31, 32, 60, 120, 300] * 2:
        base = [rng.choice(vocabulary) for _ in range(size)]
        for k in range(6):
            words = list(base)
            for _ in range(k % 4):
                at = rng.randrange(len(words))
                if rng.random() < 0.5:
                    words[at] = rng.choice(vocabulary)
                else:
                    words.append(rng.choice(vocabulary))
            if rng.random() < 0.3 and size > 20:
                words += passage
            rows.append((i, " ".join(words) if k % 2 else " ".join(words).upper()))
            i += 1
    return rows


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_equals_brute_force(spark, words, percent):
    rows = corpus() + [(1000 + (i or 0), t) for i, t in B.EDGES if i not in (10, None)]
    rows += [(2000 + k, " ".join(f"m{j}" for j in range(100 + k))) for k in range(40)]  # a chain of growing sets
    assert got(J.jaccard_join(B.documents(spark, rows), words, percent)) == B.near(rows, words, percent)


def test_leaders_and_late_pairs(spark, monkeypatch):
    """Copies of copies: the leader does not link with all, the remaining pairs must be found."""
    monkeypatch.setattr(J, "LEADER_ROUNDS", 1)
    rng = random.Random(9)
    base = [f"q{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.sample(range(150), 3):
            words[at] = f"z{rng.randrange(10_000)}"
        rows.append((k, " ".join(words)))
    assert got(J.jaccard_join(B.documents(spark, rows))) == B.near(rows)


def test_repeated_rows_nulls_and_empty(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "A  b c\nd"), (3, None), (4, " "), (None, "a b c d"), (5, "a b")]
    df = J.jaccard_join(B.documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in df if r.doc_id) == [
        (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 1, 5)]
    assert [(r.n_shingles, r.component_id) for r in df if r.doc_id is None] == [(2, None)]
    assert J.jaccard_join(B.documents(spark, [])).collect() == []


def test_texts_in_slices(monkeypatch):
    texts = ["é one Two  three four", None, "", " x ", "日本 b c d e", "a b"] * 5
    whole = [s.tolist() for s in J.shingle_sets(pa.array(texts))]
    assert [len(s) for s in whole] == [len(B.shingles(t)) for t in texts]
    monkeypatch.setattr(J, "CHUNK_BYTES", 30)
    assert [s.tolist() for s in J.shingle_sets(pa.array(["zz"] + texts).slice(1))] == whole


def test_boundary_follows_cost():
    assert J.boundary({10: 1000, 40: 1}, 90) >= 9
    assert J.boundary({}, 90) == 9


def test_a_doc_id_on_two_texts_keeps_their_families_apart(spark):
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, " ".join(a + ["x"])), (8, " ".join(b + ["y"])), (9, " ".join(b + ["z"])),
            (3, " ".join(b + ["y", "z"]))]
    found = sorted((r.doc_id, r.component_id) for r in J.jaccard_join(B.documents(spark, rows)).collect())
    assert found == [(3, 3), (5, 3), (5, 5), (7, 5), (8, 3), (9, 3)]
