"""Phrase collocations by Toivonen's sampling algorithm.

A phrase is a run of one to four words inside a piece of a text, counted per
language.  Phrases with at least ``support`` occurrences are found in these steps:

* *Sample*: a hashed share of the documents is mined level by level with a
  lowered threshold; what it finds is proposed.
* *Full pass*: over all documents every proposed phrase and the negative border
  (phrases that are not proposed but whose first words and last words both are)
  is counted exactly.  All single words are in it, as only the empty phrase is below them.
* *Expansion*: phrases of the border that reach the support are failures of the
  sample.  They join the proposal, and the border that is new is counted in a
  further pass, until a pass finds no failure.  Levels close one by one, so
  there are at most as many passes as words in a phrase.

The tasks test the proposal as a bitmap of hashes.  A phrase that hits by
chance is counted although it need not be, which changes nothing: counts are of
the phrases themselves.  The bitmap has about 16 bits per proposed phrase and at most
``MAX_BITS`` (64 MB); a larger proposal costs more rows, not results.  Phrases are
counted in each task before the shuffle, so a frequent one arrives once per
chunk of text.

Defined cases: null text is empty, null language is ``und``; an empty piece has
no words; an empty table gives no rows; repeated rows count each time.  A text is
split inside one task, which needs about 30 times its bytes.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, text_batches
from .ngram_join import mix

SUPPORT = 30
LONGEST = 4
#: The sample holds one of so many documents, and proposes from this share of the expected count on.
SAMPLE_ONE_OF = 4
LOWERED = 0.5
NO_LANG = "und"
#: Text whose phrases a task counts at once.
CHUNK_BYTES = 4 << 20
MAX_BITS = 1 << 29
OUT_ROWS = 200_000

U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)

#: Of every byte: 0 in a word, 1 blank, 2 the end of a piece; and A-Z in lower case.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def names(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words given as bytes."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w.as_buffer()) for w in words), U64, len(words))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words (bytes), and of each word: its index among them, its piece and its row."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        none = np.empty(0, np.int64)
        return pa.array([], pa.large_binary()), none, none, none
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    kind = KIND[data]
    inside = kind == 0
    first = np.empty(len(data), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(inside & first)
    count = np.int32 if len(data) < 1 << 31 else np.int64
    at = np.cumsum(inside, dtype=count)
    ends = np.append(at[starts] - 1, at[-1]).astype(np.int64)
    piece = np.cumsum(kind == 2, dtype=count)[starts]
    row = np.searchsorted(offsets[1:], starts, side="right")
    kept = LOWER[data[inside]]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(kept)])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), piece + row, row


class Proposal:
    """Hashes of phrases as a bitmap; tested in the tasks."""

    def __init__(self, spark: SparkSession, bits: np.ndarray, base: Proposal | None = None):
        self.size, self.base = len(bits) * 8, base
        self.bits = spark.sparkContext.broadcast(bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bits = self.bits.value
        out = np.ones(len(hashes), bool)
        for slot in slots(hashes, self.size):
            out &= (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        return out


def slots(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    mask = U64(size - 1)
    return [(hashes & mask).astype(np.int64), ((hashes >> U64(32)) & mask).astype(np.int64)]


def proposal(spark: SparkSession, phrases: DataFrame, count: int, base: Proposal | None = None) -> Proposal:
    """The bitmap of ``phrases`` (lang, phrase); its blocks are put together by Spark, the driver gets their bytes.

    With ``base`` it also has all that ``base`` has, so its border has the border of ``base``.
    """
    size = base.size if base else 1 << 15
    while not base and size < min(16 * count, MAX_BITS):
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pc.split_pattern(batch.column("phrase").cast(pa.large_string()), " ")
            coded = words.flatten().cast(pa.large_binary()).dictionary_encode()
            h = names(coded.dictionary)[coded.indices.to_numpy()]
            begin = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
            length = np.diff(words.offsets.to_numpy())
            langs = batch.column("lang").cast(pa.large_binary()).dictionary_encode()
            got = first_hash(h[begin], names(langs.dictionary)[langs.indices.to_numpy()])
            for k in range(1, LONGEST):
                more = length > k
                got[more] = next_hash(got[more], h[begin[more] + k])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(slots(got, size)))], names=["slot"])

    rows = (phrases.select("lang", "phrase").mapInArrow(run, "slot long")
            .groupBy(F.bitmap_bucket_number(F.col("slot") + 1).alias("block"))  # they count from 1
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("slot") + 1)).alias("bits")).collect())
    bits = base.bits.value.copy() if base else np.zeros(size // 8, np.uint8)
    for r in rows:
        bits[(r.block - 1) * 4096:r.block * 4096] |= np.frombuffer(r.bits, np.uint8)
    return Proposal(spark, bits, base)


def first_hash(word: np.ndarray, lang: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(lang * STEP + word)


def next_hash(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(phrase * STEP + word)


def border(known: Proposal, hashes: list[np.ndarray], valid: list[np.ndarray], levels: range) -> list[np.ndarray]:
    """Of each place and level: whether the phrase that starts there is proposed or in the border."""
    out = [valid[0]]
    for k in range(2, levels.stop):
        inner = out[-1] & valid[k - 2]
        hit = np.zeros(len(inner), bool)
        hit[inner] = known.has(hashes[k - 2][inner])
        both = hit.copy()
        both[:-1] &= hit[1:]
        both[-1:] = False
        out.append(both & valid[k - 1])
    return out


def counts(docs: DataFrame, levels: range, known: Proposal | None = None, before: list[Proposal] = (),
           support: int = 1) -> DataFrame:
    """lang, phrase, f of the phrases of ``levels`` words that are proposed in ``known`` or in its border.

    Those that ``before`` had are left out, as they are counted.  Only counts of ``support`` and more are
    returned, besides the number of all words of the language (phrase '') where single words are counted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs in chunks(batches):
            yield from count(texts, langs)

    def count(texts: pa.Array, langs: pa.Array) -> Iterator[pa.RecordBatch]:
        words, idx, piece, row = words_of(texts)
        if not len(idx):
            return
        langs = pc.fill_null(langs, NO_LANG).dictionary_encode()
        lang = langs.indices.to_numpy()[row].astype(np.int64)
        if 1 in levels:
            total = np.bincount(lang, minlength=len(langs.dictionary))
            used = np.flatnonzero(total)
            yield rows(langs.dictionary.take(pa.array(used)), pa.array([""] * len(used), pa.string()), total[used])
        name = names(words)[idx]
        h = [first_hash(name, names(langs.dictionary.cast(pa.large_binary()))[lang])]
        valid = [np.ones(len(idx), bool)]
        for k in range(2, levels.stop):
            same = np.zeros(len(idx), bool)
            same[:len(idx) - k + 1] = piece[k - 1:] == piece[:len(idx) - k + 1]
            longer = h[-1].copy()
            longer[:len(idx) - k + 1] = next_hash(h[-1][:len(idx) - k + 1], name[k - 1:])
            valid.append(same)
            h.append(longer)
        wanted = border(known, h, valid, levels) if known else valid
        for p in before:
            wanted = [w & ~old for w, old in zip(wanted, border(p, h, valid, levels))]
        width, ids = len(words) + 1, lang
        for k in range(1, levels.stop):
            at = np.flatnonzero(wanted[k - 1])
            if before:  # few places: the words of each from the first on
                number = lang[at]
                for t in range(k):
                    number, distinct = pd.factorize(number * width + idx[at + t])
            else:  # all places of a level are places of the one below: one more word each
                number, distinct = pd.factorize(ids[at] * width + idx[at + k - 1])
                ids = np.full(len(idx), -1, np.int64)
                ids[at] = number
            if k in levels and len(at):
                one = np.empty(len(distinct), np.int64)
                one[number[::-1]] = at[::-1]
                f = np.bincount(number, minlength=len(distinct))
                for i in range(0, len(one), OUT_ROWS):
                    some = one[i:i + OUT_ROWS]
                    parts = [words.take(pa.array(idx[some + t])) for t in range(k)]
                    phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()))
                    yield rows(langs.dictionary.take(pa.array(lang[some])), phrase.cast(pa.string()),
                               f[i:i + OUT_ROWS])

    def rows(lang: pa.Array, phrase: pa.Array, f: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([lang.cast(pa.string()), phrase, pa.array(f.astype(np.int64))],
                                          names=["lang", "phrase", "f"])

    found = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= support) | (F.col("phrase") == ""))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Texts and languages of about ``CHUNK_BYTES`` of text."""
    held, size = [], 0
    for batch in batches:
        start, ends = 0, np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + CHUNK_BYTES - size, side="right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - base)
            start = stop
            if size >= CHUNK_BYTES or start < len(ends):
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def joined(batches: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    def column(name):
        return pa.concat_arrays([b.column(name).cast(pa.large_string()) for b in batches])
    return column("text"), column("lang")


def mine(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, one_of: int = SAMPLE_ONE_OF,
         lowered: float = LOWERED, scratch: Scratch | None = None) -> DataFrame:
    """lang, phrase, f: every phrase of one to ``longest`` words with at least ``support`` occurrences, exactly.

    The row with the empty phrase holds the number of all words of the language.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "collocations")
    rows = F.count_if(F.col("phrase") != "")
    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(one_of)) == 0)
    least = max(1, int(np.ceil(lowered * support / one_of)))
    with text_batches(spark):
        proposed, found, known = [], 0, None
        for k in range(1, longest):
            level = scratch.keep(counts(sample, range(k, k + 1), known, support=least).where("phrase <> ''"),
                                 f"sample{k}", rows=rows)
            proposed.append(level)
            found += level.measured["rows"] or 0
            if not level.measured["rows"]:
                break
            known = proposal(spark, union(proposed), found)
        known = known or proposal(spark, union(proposed), 0)
        exact = [scratch.keep(counts(docs, range(1, longest + 1), known, support=support), "pass1", rows=rows)]
        before = []
        while True:
            scratch.release()
            # phrases of the last pass that the proposal lacks, and that can be part of longer ones
            failures = scratch.keep(
                exact[-1].where((F.col("phrase") != "") & (F.size(F.split("phrase", " ")) < longest))
                .join(union(proposed), ["lang", "phrase"], "left_anti"), "failures", rows=rows)
            if not failures.measured["rows"]:
                break
            proposed.append(failures)
            found += failures.measured["rows"]
            # what is counted so far; a bitmap that was built on another has its border too
            before = [*(p for p in before if p is not known.base), known]
            room = found * 8 <= known.size or known.size == MAX_BITS
            known = proposal(spark, failures, found, known) if room else proposal(spark, union(proposed), found)
            exact.append(scratch.keep(counts(docs, range(2, longest + 1), known, before, support),
                                      f"pass{len(exact) + 1}", rows=rows))
    scratch.drop(*proposed)
    return union(exact)


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0].select("lang", "phrase", "f")
    for f in frames[1:]:
        out = out.union(f.select("lang", "phrase", "f"))
    return out


def part(words: str, first: int | str, count: str) -> str:
    return f"array_join(slice({words}, {first}, {count}), ' ')"


def collocations(docs: DataFrame, first: int = 2000, cover: int = 80, scratch: Scratch | None = None,
                 **mining) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``first`` phrases of two words and more.

    The score is floor(2000000 a / (l + r)) at the cut where it is lowest.  A phrase inside a longer one
    that has ``cover`` percent of its occurrences is left out.
    """
    scratch = scratch or Scratch(docs.sparkSession, "collocations")
    found = mine(docs, scratch=scratch, **mining)
    phrases = found.where("phrase <> ''")
    words = scratch.keep(phrases.withColumn("words", F.split("phrase", " ")).where("size(words) > 1")
                         .withColumnRenamed("f", "a"), "candidates")
    cuts = words.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr(part("words", 1, "k")).alias("x"),
                       F.expr(part("words", "k + 1", "size(words)")).alias("y"))
    left = phrases.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r"))
    scored = (cuts.join(left, ["lang", "x"]).join(right, ["lang", "y"])
              .withColumn("score", F.expr("(2000000 * cast(a as decimal(20, 0)))"
                                          " div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = (words.where("size(words) > 2")
             .select("lang", "a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("k"))
             .select("lang", "a", "words", "k", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("k") + 1)).alias("i"))
             .groupBy("lang", F.expr(part("words", "i", "k")).alias("phrase")).agg(F.max("a").alias("longer")))
    exact = "cast({} as decimal(20, 0))"
    kept = scored.join(inner, ["lang", "phrase"], "left").where(
        "longer is null or " + f"100 * {exact.format('longer')} < {cover} * {exact.format('a')}")
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # the first of each part, then the first of all: no task sorts a whole language
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    top = (salted.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order)))
           .where(F.col("rank") <= first))
    top = (top.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
           .where(F.col("rank") <= first))
    total = found.where("phrase = ''").groupBy("lang").agg(F.max("f").alias("n"))
    return top.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) as phrase
  from w, (select unnest([1, 2, 3, 4])::bigint as k)),
f as (select lang, phrase, any_value(k) as k, count(*) as f from grams group by lang, phrase having count(*) >= 30),
totals as (select lang, sum(len(words))::bigint as n from w group by lang),
c as (select lang, phrase, f as a, string_split(phrase, ' ') as ws, k from f where k > 1),
cuts as (
  select lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') as x, array_to_string(ws[cut + 1:], ' ') as y
  from (select *, unnest(range(1, k)) as cut from c)),
scored as (
  select cuts.lang, cuts.phrase, a, x.f as l, y.f as r, ((2000000 * a::hugeint) // (x.f + y.f))::bigint as score,
    row_number() over (partition by cuts.lang, cuts.phrase order by (2000000 * a::hugeint) // (x.f + y.f), cut) as rn
  from cuts join f x on x.lang = cuts.lang and x.phrase = cuts.x join f y on y.lang = cuts.lang and y.phrase = cuts.y),
spans as (
  select lang, a, ws, size, unnest(range(1, k - size + 2)) as i
  from (select *, unnest(range(2, k)) as size from c)),
longer as (select lang, array_to_string(ws[i:i + size - 1], ' ') as phrase, max(a) as longer from spans group by 1, 2),
kept as (
  select s.lang, s.phrase, a, l, r, score from scored s left join longer o on o.lang = s.lang and o.phrase = s.phrase
  where rn = 1 and (longer is null or 100 * longer < 80 * a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join totals on totals.lang = ranked.lang where rank <= 2000
"""
