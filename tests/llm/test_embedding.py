import collections

import numpy as np

from wardline.llm import embedding as E

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, cap string, copies string, x string"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0,
                                   "r", "c", "k", "x") for i, v in rows], SCHEMA)


def brute(rows, cosine=0.9):
    ok = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[k] = np.asarray(v, np.float32).astype(float)
    links = collections.defaultdict(set)
    for a in ok:
        for b in ok:
            if a < b and len(ok[a]) == len(ok[b]):
                if ok[a] @ ok[b] / np.sqrt((ok[a] @ ok[a]) * (ok[b] @ ok[b])) >= cosine:
                    links[a].add(b)
                    links[b].add(a)
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for y in links[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        out.append((i, len(links[k]), min(rows[s][0] for s in seen) if i is not None else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_edges(spark):
    rng = np.random.default_rng(4)
    a, b = rng.standard_normal(64), rng.standard_normal(64)
    rows = [(0, a), (1, a * 3), (2, a + 0.05 * b), (3, a), (3, a), (4, -a), (5, None), (6, [0.0] * 64), (7, [None] * 64),
            (8, [float("nan")] + [1.0] * 63), (9, [float("inf")] * 64), (10, []), (11, a[:32]), (12, a[:32] * 2),
            (None, a), (13, [1e-30] * 64), (14, [1e30] * 64), (15, [2.0]), (16, [5.0]), (17, [-5.0])]
    assert got(E.near_duplicates(table(spark, rows))) == brute(rows)
    assert E.near_duplicates(table(spark, [])).collect() == []


def test_recall_at_the_threshold(spark):
    """Pairs with cosines from 0.9 up among random vectors: recall, and nothing below the threshold."""
    rng = np.random.default_rng(8)
    rows, want = [], set()
    for k in range(400):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(64)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        c = 0.9 + 0.03 * rng.random() if k % 2 else 0.87 + 0.02 * rng.random()
        rows += [(2 * k, x), (2 * k + 1, c * x + np.sqrt(1 - c * c) * y)]
        if k % 2:
            want.add(2 * k + 1)
    out = {r.vec_id: r for r in E.near_duplicates(table(spark, rows)).collect()}
    linked = {i for i, r in out.items() if r.n_links and i % 2}
    assert linked <= want and len(linked) >= 0.95 * len(want)


def test_decode_lists_all_caps_above_the_threshold(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((5, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    monkeypatch.setattr(E, "SHARED", 5.0)
    monkeypatch.setattr(E, "LEAST", 4000)
    rotation, words, alpha = E.code(32, 11, 0.85, 2)
    directions = np.array([np.concatenate([a, b]) for a in words[0] for b in words[1]]) @ rotation.T
    assert np.allclose(np.linalg.norm(directions, axis=1), 1)
    want = [np.flatnonzero(directions @ v >= alpha).tolist() for v in x]
    assert [sorted(found) for found in E.decode(x, 11, 0.85, 2)] == want and sum(map(len, want))


def test_caps_grow_with_the_table():
    for n in (10, 10_000, 10_000_000, 10 ** 10):
        alpha, directions = E.plan(n, 0.9, 64)
        assert np.interp(alpha, E.GRID, E.tails(64)) * n <= E.LOAD * 1.01 and directions >= E.LEAST
