import collections
import random
import re

import llm_brute as B
import pytest

from wardline.llm import collocations as C


def brute(rows, support=30, longest=4, first=2000, cover=80):
    """lang, rank, phrase, a, l, r, n, score from all phrases of all texts."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(B.LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in f.items() if a >= support}
    out = collections.defaultdict(list)
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        longer = [x for (other, q), x in frequent.items() if other == lang and len(q) > len(p)
                  and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * x >= cover * a for x in longer):
            continue
        score, _, l, r = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                             for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -score) for lang, found in out.items()
                  for rank, (score, a, p, l, r) in enumerate(sorted(found)[:first], 1))


def corpus(seed=5):
    rng = random.Random(seed)
    words = ["a", "B", "ç", "d\x00", "日本", "F-1", "g", "'h"]
    rows = []
    for i in range(300):
        text = ""
        for _ in range(rng.randrange(40)):
            text += rng.choice(words[:3 + i % 6]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ! "])
            if rng.random() < 0.1:
                text += "new york city hall "
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    return rows + [("en", None), (None, None), ("de", ""), ("de", ".,;\n"), ("en", "x " * 3000), ("nul", "b"),
                   ("en", rows[0][1]), ("en", rows[0][1])]


def documents(spark, rows):
    full = [(i, t, lang, *["x"] * 8) for i, (lang, t) in enumerate(rows)]
    extra = ", ".join(f"{c} string" for c in ("phrase", "f", "a", "k", "words", "rank", "score", "n"))
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, {extra}")


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("support,first,one_of", [(30, 2000, 4), (4, 25, 2)])
def test_equals_brute_force(spark, support, first, one_of):
    rows = corpus()
    df = C.collocations(documents(spark, rows), first=first, support=support, one_of=one_of)
    want = brute(rows, support=support, first=first)
    assert len(want) > 20 and got(df) == want


def test_a_sample_without_rows_is_made_good_by_expansion(spark):
    """Nothing is proposed, so every frequent phrase is a failure of the border."""
    rows = corpus(6)[:120]
    assert got(C.collocations(documents(spark, rows), support=8, one_of=1 << 40)) == brute(rows, support=8)


def test_small_chunks_and_crowded_bitmaps_change_nothing(spark, monkeypatch):
    rows = corpus(7)[:100]
    with monkeypatch.context() as m:
        m.setattr(C, "MAX_BITS", 1 << 15)
        m.setattr(C, "CHUNK_BYTES", 50)
        m.setattr(C, "OUT_ROWS", 3)
        assert got(C.collocations(documents(spark, rows), support=5)) == brute(rows, support=5)


def test_empty_table_and_cover(spark):
    assert got(C.collocations(documents(spark, []))) == []
    rows = [("en", "one two three. one two")] * 40 + [("en", "one two")] * 9
    df = C.collocations(documents(spark, rows))
    assert got(df) == brute(rows)
    assert [r[2] for r in got(df)] == ["one two", "one two three"]


def test_score_is_exact_beyond_64_bits(spark):
    expr = "(2000000 * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"
    a, l, r = 9_000_000_000_000_007, 9_100_000_000_000_013, 9_200_000_000_000_021
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long").selectExpr(f"{expr} as score").first()
    assert row.score == 2_000_000 * a // (l + r)
