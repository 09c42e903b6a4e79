import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from wardline.llm import prefix_trie as T


def brute(rows):
    """Node rows of the rebuilt conversations of ``rows`` (conv_id, turn, role, text), from all prefixes."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[c].append(((turn is not None, turn or 0), name, (role, text)))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return trie(built)


def trie(built):
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(re.findall("[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * words
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows):
    extra = ("k", "d", "name", "words", "l", "r", "pos", "chunk", "rank", "q", "block", "depth", "base", "h")
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in extra)
    return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def corpus(seed, convs=150, longest=9, kinds=3):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.1:
            continue  # also bases that are absent
        length = rng.choice([1, 1, 2, 3, 5, longest])
        for t in range(length):
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", None, "assistant"]),
                         rng.choice(["", None, "hello  there", "a\tb\nc d"][:kinds]) if t < 4 else f"text {t}"))
    rng.shuffle(rows)
    return rows + rows[:5] + [(None, 1, "user", "x")]


@pytest.mark.parametrize("seed,kinds", [(1, 3), (2, 1)])
def test_equals_brute_force(spark, seed, kinds):
    rows = corpus(seed, kinds=kinds)
    assert got(T.conversation_trie(conversations(spark, rows))) == brute(rows)


def test_small_blocks_chunks_and_batches(spark, monkeypatch):
    """Searches over many blocks, ties over many rounds, joined ids and steps of depths."""
    for name, value in (("BLOCK", 7), ("CHUNK", 1), ("MAX_CHUNK", 2), ("JOINED", 3)):
        monkeypatch.setattr(T, name, value)
    rows = corpus(3, 110)
    rows += [(1000 + c, t, "user", "same") for c in range(30) for t in range(12 + c % 2)]
    assert got(T.conversation_trie(conversations(spark, rows))) == brute(rows)


def test_few_rows(spark):
    assert got(T.conversation_trie(conversations(spark, []))) == []
    assert got(T.conversation_trie(conversations(spark, [(None, 0, "a", "b")]))) == []
    for rows in ([(7, 0, "user", "one two")], [(41, 0, "u", "x"), (42, 0, "u", "x"), (43, 0, "u", "x")],
                 [(c, 0, None, "word " * 50_000) for c in (0, 1, 2, 20, 21)]):
        assert got(T.conversation_trie(conversations(spark, rows))) == brute(rows)


def test_one_conversation_of_a_third_of_all_turns(spark):
    rows = [(5, t, "user", f"turn {t}") for t in range(250)] + [(c, t, "user", f"turn {t}") for c in range(20, 90)
                                                               for t in range(c % 10 + 3)]
    assert got(T.conversation_trie(conversations(spark, rows))) == brute(rows)


def test_sparse_table_equals_scans():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 17, 64, 100):
        values = rng.integers(-1, 6, size)
        table = T.Minima(values)
        lo, hi = rng.integers(0, size, 200), rng.integers(-1, size, 200)
        want = [values[a:b + 1].min() if b >= a else T.NONE for a, b in zip(lo, hi)]
        assert table.least(lo, hi).tolist() == want
        start, depth = rng.integers(0, size + 1, 200), rng.integers(-1, 7, 200)
        assert table.right(start, depth).tolist() == [
            next((j for j in range(s, size) if values[j] < d), size) for s, d in zip(start, depth)]
        assert table.left(start, depth).tolist() == [
            next((j for j in range(s - 1, -1, -1) if values[j] < d), -1) for s, d in zip(start, depth)]
