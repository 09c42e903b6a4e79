"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import collections
import hashlib
import re

WHITE = "[\x20\x09-\x0D]"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Columns that the operators use inside, as strangers in their input.
CLASHES = ("name", "h", "rep", "n", "key", "level", "left", "a", "b", "one", "salt", "pos", "l", "toxic", "grade",
           "kept", "first", "copy", "page", "host", "rows", "template", "component", "comp", "topic", "copies")


def documents(spark, rows):
    """``rows`` (doc_id, text) as documents with strange columns."""
    full = [(i, t, "en" if t else None, None if i is None else f"s{i % 3}", None, *["x"] * len(CLASHES))
            for i, t in rows]
    extra = ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


EDGES = [(0, None), (1, ""), (2, " \t\n"), (3, "alpha beta"), (4, "alphabeta"), (5, "alpha beta "), (6, "ALPHA beta"),
         (7, "x" * 50_000), (8, "word " * 20_000), (9, "word" * 20_000), (None, "lonely text without id"),
         (10, "twice the very same row"), (10, "twice the very same row"), (11, "twice  the very same row"),
         (12, "é" * 300 + " 日本 😀"), (13, "é" * 300 + " 日本 😀!")]


def exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        t = t or ""
        groups[re.sub(WHITE, "", t)].append((-len(t), i is None, i if i is not None else 0, i))
    out = []
    for norm, members in groups.items():
        first, *others = sorted(members, key=lambda m: m[:3])
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(m[3], first[3], len(members), m is first, sha) for m in (first, *others)]
    return sorted(out, key=str)


def shingles(text, words=3):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) >= words:
        return frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near(rows, words=3, percent=90):
    """doc_id -> (set size, component) by comparing all sets that share a shingle."""
    sets = {i: shingles(t, words) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = collections.defaultdict(set)
    for i, s in sets.items():
        for g in s:
            lists[g].add(i)
    seen = set()
    for members in lists.values():
        for i in members:
            for j in members:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        x, y = find(i), find(j)
                        parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for p, label in BASE.items() for i in range(len(words))
              if words[i:i + len(p.split())] == p.split()]
    return (len(words), len(places), min((i for i, _ in places), default=None),
            max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places})))
