"""License scan with a positional index of rare license words.

The index holds, for every template (a short phrase or a notice), the positions
of its words.  Document frequencies of these words are counted over the whole
corpus, and each template is looked up by its highest-IDF words.  In a file,
every occurrence of such a word proposes the places where its templates would
start; proposals of several words are intersected by their relative position,
the rest of the template is compared in place, and a match counts only if the
template's mandatory key phrases stand there.

Phrases must match word for word; all their places are counted.  A notice
matches if the IDF-weighted share of its words that stand in place is at least
``NOTICE_SHARE``; ``score`` is the largest share of any match of the file.

Words are maximal runs of ASCII letters (A-Z lower-cased), digits and
characters outside ASCII.  Defined cases: null text counts as empty; a file
without a match has no labels (empty strings), null first_word and last_word and
score 0.  Repeated rows are scanned each, other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words by which a notice is looked up, and how many of them must agree on a place.
ANCHORS, AGREE = 4, 2
NOTICE_SHARE = 0.7

# fixed values: base phrases and their labels
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# fixed values: public licence notices (label, text, mandatory key phrases)
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the "
                   "license at", ["in compliance with the license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc", "4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa", "4 0"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4 0"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files", ["permission is hereby granted free of charge"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", ["permission to use copy modify"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
]

_ASCII = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c for c in _ASCII)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).split()


def find_phrase(words: list[bytes], phrase: list[bytes], start: int, stop: int) -> bool:
    return any(words[i:i + len(phrase)] == phrase for i in range(start, max(start, stop - len(phrase)) + 1))


@dataclass
class Template:
    label: str
    words: list[bytes]
    mandatory: list[list[bytes]]
    exact: bool


def templates(phrases: dict[str, str] | None = None, notices: list | None = None) -> list[Template]:
    phrases, notices = PHRASES if phrases is None else phrases, NOTICES if notices is None else notices
    return ([Template(label, p.encode().split(), [p.encode().split()], True) for p, label in phrases.items()]
            + [Template(label, t.encode().split(), [k.encode().split() for k in keys], False)
               for label, t, keys in notices])


class Index:
    """Positional postings of the templates' highest-IDF words."""

    def __init__(self, parts: list[Template], idf: dict[bytes, float]):
        self.parts, self.idf = parts, idf
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, part in enumerate(parts):
            rarest = sorted(set(part.words), key=lambda w: (-idf[w], w))[:1 if part.exact else ANCHORS]
            for pos, w in enumerate(part.words):
                if w in rarest:
                    self.postings[w].append((t, pos))
        self.anchors = frozenset(self.postings)
        self.weight = [sum(idf[w] for w in p.words) for p in parts]

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share of it that stands there) of every match."""
        if self.anchors.isdisjoint(words):
            return []
        votes: Counter = Counter()
        for i, w in enumerate(words):
            if w in self.anchors:
                for t, pos in self.postings[w]:
                    votes[t, i - pos] += 1
        out = []
        for (t, start), n in sorted(votes.items()):
            part = self.parts[t]
            stop = start + len(part.words)
            if part.exact:
                if start >= 0 and words[start:stop] == part.words:
                    out.append((t, start, 1.0))
            elif n >= min(AGREE, len(part.words)):
                at = max(start, 0)
                here = sum(self.idf[w] for j, w in enumerate(part.words)
                           if 0 <= start + j < len(words) and words[start + j] == w)
                share = here / self.weight[t] if self.weight[t] else 0.0
                if share >= NOTICE_SHARE and all(find_phrase(words, k, at, min(stop + 2, len(words)))
                                                 for k in part.mandatory):
                    out.append((t, start, min(share, 1.0)))
        return out


def word_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """Documents that hold each word of the (small) vocabulary, and all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(vocabulary.intersection(words_of(text.as_py())))
                counts[b""] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([counts[k] for k in keys], pa.int64())],
                                         names=["word", "n"])

    rows = (docs.select("text").mapInArrow(run, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())  # a row for each vocabulary word at most
    found = {bytes(r.word): r.n for r in rows}
    return {w: found.get(w, 0) for w in vocabulary}, found.get(b"", 0)


def build_index(docs: DataFrame, parts: list[Template] | None = None) -> Index:
    parts = templates() if parts is None else parts
    df, n = word_frequencies(docs, {w for p in parts for w in p.words})
    return Index(parts, {w: math.log((n + 1) / (c + 1)) + 1e-6 for w, c in df.items()})


def scan(docs: DataFrame, index: Index) -> DataFrame:
    """One row for every row of ``docs`` (doc_id, text); ``spans`` lists (label, start, words, share) of all matches."""
    schema = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, spans array<struct<label: string, start: long, words: int, share: double>>")
    span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("words", pa.int32()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for text in batch.column("text"):
                words = words_of(text.as_py())
                found = index.matches(words)
                base = [(index.parts[t].label, s) for t, s, _ in found if index.parts[t].exact]
                for col, v in zip(cols, (
                        len(words), len(base), min((s for _, s in base), default=None),
                        max((s for _, s in base), default=None), ",".join(sorted({x for x, _ in base})),
                        ",".join(sorted({index.parts[t].label for t, _, _ in found})),
                        round(max((c for _, _, c in found), default=0.0), 6),
                        [{"label": index.parts[t].label, "start": max(s, 0), "words": len(index.parts[t].words),
                          "share": round(c, 6)} for t, s, c in found])):
                    col.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                       "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
