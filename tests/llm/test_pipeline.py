import os

import llm_brute as B
from pyspark.sql import functions as F

import corpus_pipeline as P
from wardline.llm import mixing, toxicity
from wardline.llm.registry import QUERIES, WORD_BPE, table

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    """Every stage on all its predecessor kept, against plain Python on the collected rows."""
    docs = table(spark, SF, "documents").select(*P.COLUMNS)
    model = toxicity.fit(docs, table(spark, SF, "labels"))
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = {i: t for i, t in rows.items() if model.probabilities(model.score(t))[0] < toxicity.TOXIC}
    rows = {i: rows[i] for i, keep, *_ in B.exact(list(rows.items())) if i == keep}
    groups = B.near(list(rows.items()), 5, 80)
    rows = {i: t for i, t in rows.items() if groups[i][1] == i}
    left = docs.where(F.col("doc_id").isin(list(rows)))
    mix = mixing.fit(left)
    sampled = {r.doc_id for r in mixing.decide(left, mix).collect() if r.kept}
    got = P.run(spark, SF).collect()
    assert {r.doc_id for r in got} == sampled and len(got) == len(sampled)
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORD_BPE)
    assert all(r.n_tokens == len(t.encode(rows[r.doc_id], add_special_tokens=False).ids) for r in got)


def test_stages_keep_the_columns_and_odd_rows(spark):
    docs = B.documents(spark, B.EDGES)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == P.COLUMNS, name
        assert out.count() > 0, name
        assert stage(spark, B.documents(spark, []), SF).count() == 0, name


def test_one_query_per_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and os.path.exists(WORD_BPE)


def test_rows_that_share_a_doc_id_or_have_none(spark):
    rows = [(1, "one text"), (1, "one text"), (1, "another text"), (2, "one  text"), (None, "lonely"), (None, "lonely"),
            (3, "another text"), (None, "one text")]
    out = sorted((str(r.doc_id), r.text) for r in P.distinct(spark, B.documents(spark, rows), SF).collect())
    assert out == [("1", "another text"), ("2", "one  text"), ("None", "lonely")]
    near = [(5, "a b c d e f"), (5, "g h i j k l"), (4, "g h i j k l"), (6, "A b c d e f")]
    out = sorted((r.doc_id, r.text) for r in P.different(spark, B.documents(spark, near), SF).collect())
    assert out == [(4, "g h i j k l"), (5, "a b c d e f")]
