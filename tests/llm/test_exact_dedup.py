import random

import llm_brute as B

from wardline.llm import exact_dedup as X


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_edges(spark):
    rows = B.EDGES + [(20, None), (21, "\x0b\x0c\r")]
    assert got(X.exact_dedup(B.documents(spark, rows))) == B.exact(rows)


def test_long_texts_that_differ_late(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK_BYTES", 16)
    rng = random.Random(5)
    base = "".join(rng.choice("ab ") for _ in range(700))
    rows = [(i, base) for i in range(30)] + [(30 + i, base[:-1 - i] + "c" + base[len(base) - i:]) for i in range(20)]
    rows += [(60 + i, base[:16 * i]) for i in range(20)] + [(90, base[:333].replace(" ", "  "))] + [(91, base[:333])]
    assert got(X.exact_dedup(B.documents(spark, rows))) == B.exact(rows)


def test_hot_blocks_go_by_broadcast(spark, monkeypatch):
    monkeypatch.setattr(X, "HOT_SHARE", 20)
    monkeypatch.setattr(X, "BLOCK_BYTES", 8)
    rows = [(i, "same opening words then number " + str(i // 3 if i % 2 else 0)) for i in range(120)]
    assert got(X.exact_dedup(B.documents(spark, rows))) == B.exact(rows)


def test_empty_table(spark):
    assert got(X.exact_dedup(B.documents(spark, []))) == []


def test_one_row_stays_where_rows_share_a_doc_id(spark):
    rows = [(5, "a b"), (5, "ab"), (6, "ab"), (7, "x y"), (7, "x y"), (7, "xy "), (None, "zz"), (None, "z z"), (8, "zz")]
    df = X.exact_dedup(B.documents(spark, rows)).collect()
    kept = [r for r in df if r.kept]
    assert len(df) == 9 and sorted((r.doc_id or 0, r.group_size) for r in kept) == [(0, 3), (5, 3), (7, 3)]
    assert len({r.text_hash for r in df if r.doc_id == 5}) == 2
