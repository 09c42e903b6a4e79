import llm_brute as B
import numpy as np
import pytest

from wardline.llm import mixing as M


def test_rake_meets_all_marginals():
    rng = np.random.default_rng(3)
    tokens = rng.integers(1, 100, (4, 3, 2)).astype(float)
    tokens[0, 1, 1] = 0
    targets = [np.array([.1, .2, .3, .4]), np.array([.5, .25, .25]), np.array([.7, .3])]
    fitted = M.rake(tokens, targets) * tokens
    for axis, t in enumerate(targets):
        have = fitted.sum(axis=tuple(a for a in range(3) if a != axis)) / fitted.sum()
        assert np.allclose(have, t, atol=1e-8)
    # weights are a product of one factor per category
    w = M.rake(tokens, targets)
    assert w[1, 0, 0] * w[2, 2, 1] * 1.0 == pytest.approx(w[2, 0, 0] * w[1, 2, 1])


def rows(n=3000):
    return [(i, f"word{i} alphabet{i % 7} " + "tok " * (i % 13), "en" if i % 4 else "de", "hot" if i % 3 else f"s{i % 9}",
             None, "x") for i in range(n)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, topic string"


def test_sample_has_the_target_shares(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    mix = M.fit(docs, {"source": {"hot": .4, "s0": .2, "s3": .2, "s6": .2}, "lang": {"en": .5, "de": .5}})
    out = M.decide(docs, mix).collect()
    expected = sum(r.n_tokens * r.probability for r in out)
    for key, want in {("source", "hot"): .4, ("lang", "de"): .5}.items():
        have = sum(r.n_tokens * r.probability for r in out if r[key[0]] == key[1])
        assert have / expected == pytest.approx(want, abs=1e-6)
    assert max(r.probability for r in out) == pytest.approx(1)
    kept = M.keep(docs, mix, docs.columns).collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in out if r.kept} and kept[0].topic == "x"
    assert sum(r.n_tokens for r in out if r.kept) == pytest.approx(expected, rel=0.1)


def test_folded_sources_and_budget(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    mix = M.fit(docs, max_categories=2, budget=0.3)
    assert len(mix.axes[0]) == 3 and len({c[0] for c in mix.weights}) == 3
    out = M.decide(docs, mix).collect()
    assert sum(r.n_tokens * r.probability for r in out) / sum(r.n_tokens for r in out) == pytest.approx(.3, abs=1e-6)


def test_edges(spark):
    docs = B.documents(spark, B.EDGES)
    out = M.decide(docs, M.fit(docs)).collect()
    assert len(out) == len(B.EDGES)
    twice = [r.kept for r in out if r.doc_id == 10]
    assert len(twice) == 2 and twice[0] == twice[1]
    empty = B.documents(spark, [])
    assert M.decide(empty, M.fit(empty)).collect() == []
    none = B.documents(spark, [(1, None), (2, " ")])
    assert all(r.kept for r in M.decide(none, M.fit(none)).collect())


def test_one_tiny_category_does_not_shrink_the_sample(spark):
    big = [(i, "tok " * 2000, "en", f"s{i % 4}", None, "x") for i in range(400)]
    docs = spark.createDataFrame([*big, (400, "tok", "stray", "s0", None, "x")], SCHEMA)
    out = M.decide(docs, M.fit(docs)).collect()
    expected = sum(r.n_tokens * r.probability for r in out)
    assert expected / sum(r.n_tokens for r in out) == pytest.approx(M.BUDGET, abs=1e-6)
    assert next(r for r in out if r.lang == "stray").kept
    assert all(r.probability > 0.7 for r in out)


def test_a_source_of_one_rare_language_keeps_every_cell():
    tokens = np.zeros((20, 2, 1))
    tokens[:, 0, 0] = 1000
    tokens[0, :, 0] = 100, 900
    share = [tokens.sum(axis=tuple(a for a in range(3) if a != k)) / tokens.sum() for k in range(3)]
    targets = [s ** M.TEMPER / (s ** M.TEMPER).sum() for s in share]
    assert targets[1][1] > targets[0][0]  # cannot hold together
    w = M.rake(tokens, targets)
    assert w[tokens > 0].min() > 0.05 and (w[tokens == 0] == 0).all()
    have = (w * tokens).sum(axis=(1, 2)) / (w * tokens).sum()
    assert np.allclose(have[1:], have[1]) and have[1] == pytest.approx(.05, rel=.1)


def test_targets_that_cannot_hold_together_are_reported(spark):
    docs = spark.createDataFrame([(i, "tok " * 10, "xx" if i % 20 == 0 and i % 200 else "en", f"s{i % 20}", None, "x")
                                  for i in range(2000)], SCHEMA)
    with pytest.warns(UserWarning, match="cannot hold together"):
        mix = M.fit(docs)
    out = M.decide(docs, mix).collect()
    assert max(mix.missed, key=mix.missed.get) == ("source", "s0") and mix.missed["source", "s0"] > 1.2
    assert not any(r.on_target for r in out if r.source == "s0")
    assert min(r.probability for r in out) > 0.05
    assert sum(r.probability for r in out) / len(out) == pytest.approx(M.BUDGET, abs=1e-6)


def test_no_source_is_folded(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (1 + i % 3), "en" if (i + i // 1200) % 2 else "de", f"s{i % 1200}", None,
                                   "x") for i in range(2400)], SCHEMA)
    goal = {"source": {f"s{k}": 1 + k % 2 for k in range(1200)}}
    mix = M.fit(docs, goal)
    assert len({c[0] for c in mix.weights}) == 1200
    assert min(r.probability for r in M.decide(docs, mix).collect()) > 0
    few = M.fit(docs, goal, max_categories=1000)  # the stratum of the others has the sum of their targets
    assert min(r.probability for r in M.decide(docs, few).collect()) > 0


def test_cells_as_a_table_give_the_same(spark):
    docs = spark.createDataFrame(rows(600), SCHEMA)
    one, other = M.fit(docs), M.fit(docs, driver_cells=5)
    assert other.table is not None
    want = {r.doc_id: r for r in M.decide(docs, one).collect()}
    got = M.decide(docs, other).collect()
    assert len(got) == 600
    for r in got:
        assert r.probability == pytest.approx(want[r.doc_id].probability, rel=1e-2) and r.topic == want[r.doc_id].topic
    kept = M.keep(docs, other, docs.columns)
    assert kept.columns == docs.columns
    assert len({r.doc_id for r in kept.collect()} ^ {i for i, r in want.items() if r.kept}) <= 3
