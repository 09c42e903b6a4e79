"""N-gram Jaccard join: size-aware, subsets for small sets, inverted lists for large ones.

A document's set holds its distinct word shingles.  Sets that are equal are
represented by the one with the smallest doc_id; links are sought between
representatives.

* Small sets (size up to a boundary) are joined on subsets: two sets that link
  share a subset of at least ``t`` of their elements, so each small set posts
  the keys of all its subsets with up to ``floor((1 - t) n)`` elements left out.
* Large sets are joined on inverted lists: in one global order of all shingles,
  two sets that link share an element among the first ``n - ceil(t n) + 1`` of
  each, so only those are posted.  The order begins with a share of the shingle
  space (twice that of a prefix), rarest first by document frequency over the
  whole corpus; the other shingles follow by hash.  Shingles that one set
  alone holds fill places of the prefix but need no list, so a text without
  near copies usually posts nothing at all.  The sets that do share a list are
  then posted once more, in the order of all shingles by their frequency among
  these sets, which leaves the lists of sets that can really link.
* The boundary is the size at which the rows of the two ways cost least, from
  the counts of all small sizes.

Lists become links without all pairs of a list: first every member is verified
against the list's leader (the set with the fewest elements of its own), then,
for lists that still span several components, against other leaders, and at
last all pairs of a list that lie in different components.  A pair is considered
only at shared elements early enough in both orders for the rest to suffice, as
the first shared element of sets that link is.  So no link between components is
lost, and a large group of near copies costs a pair or two per
member.  Verification counts the exact intersection of the two whole texts.

Defined cases: null text counts as empty; a text with no words has the empty
set, size 0, and links with nothing; fewer words than a shingle make one
element.  A row without doc_id is not linked (component_id null).  Repeated
rows are copies; rows of one doc_id with different texts are rows of their own,
each with the component of its text.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

WORDS = 3
#: Similarity as a fraction, in whole numbers: 100 * intersection >= 90 * union.
PERCENT = 90
#: Largest size that may be joined on subsets.
SMALL = 29
LEADER_ROUNDS = 3
#: Text that one Python worker turns into shingles at once.
CHUNK_BYTES = 4 << 20

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle names of each text (null: empty), a few megabytes of text at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
        # a copy, as Arrow's ascii kernels read a slice of large strings from the wrong place
        yield from _shingle_sets(texts.take(pa.array(np.arange(start, stop))), words)
        start = stop


def _shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten().dictionary_encode()
    names = np.fromiter((xxhash.xxh3_64_intdigest(w.as_py()) for w in flat.dictionary), U64, len(flat.dictionary))
    h = names[flat.indices.to_numpy()] if len(names) else np.empty(0, U64)
    with np.errstate(over="ignore"):
        one = mix(h + U64(1))
        runs = one
        for k in range(1, words):
            runs = mix(runs[:-1] * U64(0x9E3779B97F4A7C15) + h[k:]) if len(runs) > 1 else runs[:0]
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    empty = (pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0)
    for i, none in enumerate(empty):
        start, end = int(offsets[i]), int(offsets[i + 1])
        if none:
            yield np.empty(0, U64)
        elif end - start >= words:
            yield np.unique(runs[start:end - words + 1])
        else:
            yield np.array([xxhash.xxh3_64_intdigest(h[start:end].tobytes(), seed=end - start)], U64)


def enough(both: int, a: int, b: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def least(n: int, percent: int) -> int:
    """Elements of a set of size ``n`` that any set it links with must hold."""
    return -(-percent * n // 100)


def ordered_share(percent: int) -> float:
    """Share of the shingle space that is ordered by document frequency: twice the share of a prefix."""
    return min(1.0, 2 * (100 - percent) / 100)


def sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, fp, and of each set: the ordered elements, further prefix elements, all elements if small."""
    limit = U64(min(2 ** 64 - 1, int(ordered_share(percent) * 2 ** 64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fp, ordered, further, small = [], [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                size, m = len(s), int(np.searchsorted(s, limit))
                prefix = size - least(size, percent) + 1 if size else 0
                n.append(size)
                fp.append(xxhash.xxh3_128_digest(s.tobytes()))
                ordered.append(s[:m].view(np.int64))
                further.append(s[m:max(m, prefix)].view(np.int64))
                small.append(s.view(np.int64) if size <= SMALL else None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"), pa.array(n, pa.int32()),
                 pa.array(fp, pa.binary()), pa.array(ordered, longs), pa.array(further, longs), pa.array(small, longs)],
                names=["doc_id", "text_hash", "n", "fp", "ordered", "further", "small"])

    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, n int, fp binary, ordered array<long>, further array<long>, small array<long>")


def boundary(counts: dict[int, int], percent: int) -> int:
    """The size up to which subsets cost fewer rows than inverted lists."""
    def subsets(n: int) -> int:
        return sum(math.comb(n, k) for k in range(n - least(n, percent) + 1))

    def lists(n: int) -> float:
        return 2 * ordered_share(percent) * n + (n - least(n, percent) + 1)

    def cost(s: int) -> float:
        return (sum(c * subsets(n) for n, c in counts.items() if n <= s)
                + sum(c * lists(n) for n, c in counts.items() if n >= least(s + 1, percent)))

    return min(range(9, SMALL + 1), key=cost)


def subset_postings(reps: DataFrame, limit: int, percent: int) -> DataFrame:
    """key, rep, n, own, pos for every subset of the small sets that a partner could share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, reps_, sizes = [], [], []
            for rep, elements in zip(batch.column("rep").to_pylist(), batch.column("small")):
                e = mix(elements.values.to_numpy().view(U64))
                with np.errstate(over="ignore"):
                    total = e.sum(dtype=U64)
                    for k in range(len(e) - least(len(e), percent) + 1):
                        left = np.fromiter(combinations(range(len(e)), k), np.dtype((int, (k,)))) if k else None
                        sums = total - e[left].sum(1, dtype=U64) if k else np.array([total], U64)
                        got = mix(sums + U64(len(e) - k))
                        keys.append(got.view(np.int64))
                        reps_.append(np.full(len(got), rep))
                        sizes.append(np.full(len(got), len(e), np.int32))
            if keys:
                count = sum(map(len, keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(reps_).astype(np.int64)),
                     pa.array(np.concatenate(sizes)), pa.array(np.zeros(count, np.int32)),
                     pa.array(np.zeros(count, np.int32))], names=["key", "rep", "n", "own", "pos"])

    return (reps.where((F.col("n") <= limit)).select("rep", "small")
            .mapInArrow(run, "key long, rep long, n int, own int, pos int"))


def list_postings(scratch: Scratch, elements: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """key, rep, n, own, pos for the prefix elements of the large sets that another set holds too.

    ``elements`` (rep, key): those ordered by frequency, read twice, so from a written table; ``sizes`` (rep, n, m,
    further): the size of each set, the number of its ordered elements and the elements that follow in its prefix.

    ``own`` counts the elements of the set alone, which come first in the order; ``pos`` is the element's place in it.
    """
    shared = scratch.keep(elements.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "frequencies")
    scratch.release()
    hits = (elements.join(shared, "key").groupBy("rep")
            .agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("hits")))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1
    rows = (sizes.select("rep", "n", "m", prefix.alias("prefix"), "further")
            .join(hits, "rep", "left")
            .withColumn("found", F.coalesce(F.size("hits"), F.lit(0)))
            .withColumn("found", F.when(F.col("hits").isNull(), 0).otherwise(F.col("found")))
            .withColumn("own", F.col("m") - F.col("found"))
            .withColumn("take", F.greatest(F.least(F.col("m"), F.col("prefix")) - F.col("own"), F.lit(0))))
    rows = rows.select(
        "rep", "n", "own",
        F.concat(F.when(F.col("take") > 0, F.transform(F.slice("hits", F.lit(1), F.col("take")), lambda h: h["key"]))
                 .otherwise(F.array().cast("array<long>")), F.col("further")).alias("keys"))
    out = scratch.keep(rows.where(F.size("keys") > 0).select(F.posexplode("keys").alias("at", "key"), "rep", "n", "own")
                       .select("key", "rep", "n", "own", (F.col("own") + F.col("at")).alias("pos")), "lists")
    scratch.drop(shared)
    return out


def verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) with ``linked``: the exact Jaccard test on the whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            x = shingle_sets(batch.column("text_a"), words)
            y = shingle_sets(batch.column("text_b"), words)
            for s, t in zip(x, y):
                got.append(enough(len(np.intersect1d(s, t, True)), len(s), len(t), percent))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(got, pa.bool_())],
                                             names=["a", "b", "linked"])

    both = (pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b"))
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, linked boolean")


def shared(postings: DataFrame) -> DataFrame:
    """Representatives that share a key with another one."""
    keys = postings.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    return postings.join(keys, "key").groupBy("rep").agg(F.lit(1).alias("one")).select("rep")


def named_texts(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """rep, text of the rows of ``docs`` whose set is that of ``wanted`` (rep, id, fp).

    A doc_id that stands on several texts gives each representative its own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [xxhash.xxh3_128_digest(s.tobytes()) == fp for s, fp in
                    zip(shingle_sets(batch.column("text"), words), batch.column("fp").to_pylist())]
            yield batch.select(["rep", "text"]).filter(pa.array(same, pa.bool_()))

    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("id"))
    found = rows.select("rep", "fp", "text").mapInArrow(run, "rep long, text string")
    return found.dropDuplicates(["rep"])


def whole_sets(texts: DataFrame, words: int, smallest: int) -> DataFrame:
    """rep and all elements of every text with at least ``smallest`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            sets = [s.view(np.int64) if len(s) >= smallest else None
                    for s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(sets, longs)], names=["rep", "elements"])

    return texts.select("rep", "text").mapInArrow(run, "rep long, elements array<long>")


def links(scratch: Scratch, texts: DataFrame, postings: DataFrame, words: int, percent: int) -> DataFrame:
    """node, component of every representative that links with another."""
    # at the first element that two sets share, what is left of either must suffice
    sizes = ((F.least("n", "m") * 100 >= F.greatest("n", "m") * percent)
             & (F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("place")) * (100 + percent)
                >= (F.col("n") + F.col("m")) * percent))
    many = scratch.keep(
        postings.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("own", "rep", "n", "pos")).alias("lead"))
        .where("c > 1").select("key", F.col("lead.rep").alias("lead"), F.col("lead.n").alias("m"),
                               F.col("lead.pos").alias("place")), "keys")
    lists = scratch.keep(postings.join(many, "key").select("key", "rep", "n", "pos", "lead", "m", "place"),
                         "shared-lists")
    scratch.drop(many)
    pairs = (lists.where("rep <> lead").where(sizes)
             .groupBy(F.col("rep").alias("a"), F.col("lead").alias("b")).agg(F.lit(1).alias("one")).select("a", "b"))
    pairs = scratch.keep(pairs, "pairs")
    tried = [scratch.keep(verify(pairs, texts, words, percent), "verified")]
    scratch.drop(pairs)
    shared_lists, found = lists, None
    lists = lists.select("key", "rep", "n", "pos")
    for step in range(LEADER_ROUNDS + 1):
        if found is not None:
            scratch.drop(found)
        found = components(scratch, union(tried).where("linked").select("a", "b"))
        at = scratch.keep(
            lists.join(found, lists["rep"] == found["node"], "left")
            .select("key", "rep", "n", "pos", F.coalesce("component", "rep").alias("comp")), "placed", rows=F.count(F.lit(1)))
        # lists that still span components, a leader for each, another one every round
        turn = F.xxhash64("rep", F.lit(step))
        open_ = scratch.keep(
            at.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("c"),
                                  F.min(F.struct(turn.alias("t"), F.col("rep"), F.col("n"), F.col("pos"), F.col("comp"))).alias("l"))
            .where("lo < hi").select("key", "c", F.col("l.rep").alias("lead"), F.col("l.n").alias("m"),
                                     F.col("l.pos").alias("place"), F.col("l.comp").alias("lead_comp")), "open",
            rows=F.count(F.lit(1)), pairs=F.sum(F.col("c").cast("double") * F.col("c")))
        if not open_.measured["rows"]:
            scratch.drop(open_, at)
            break
        # all pairs at once where they are few, which links the same documents
        last = step == LEADER_ROUNDS or open_.measured["pairs"] <= 4 * at.measured["rows"]
        if not last:
            new = (at.join(open_, "key").where("comp <> lead_comp").where(sizes)
                   .select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")))
        else:
            left = at.join(open_.select("key"), "key", "left_semi")
            right = left.select("key", F.col("rep").alias("other"), F.col("n").alias("m"), F.col("pos").alias("place"),
                                F.col("comp").alias("oc"))
            new = (left.join(right, "key").where((F.col("rep") < F.col("other")) & (F.col("comp") != F.col("oc")))
                   .where(sizes).select(F.col("rep").alias("a"), F.col("other").alias("b")))
        known = union(tried).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        new = scratch.keep(new.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")
                           .join(known, ["a", "b"], "left_anti"), "pairs")
        more = scratch.keep(verify(new, texts, words, percent), "verified", linked=F.count_if("linked"))
        scratch.drop(open_, at, new)
        if last:
            tried.append(more)
            if more.measured["linked"]:
                scratch.drop(found)
                found = components(scratch, union(tried).where("linked").select("a", "b"))
            break
        tried.append(more)
    scratch.drop(shared_lists, *tried)
    return found


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                 scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash for every row of ``docs`` (doc_id, text).

    ``text_hash`` is xxhash64 of the text (null: empty), by which rows of one doc_id are told apart.
    """
    scratch = scratch or Scratch(docs.sparkSession, "ngram-join")
    # rows have numbers of their own, as a doc_id may stand on several texts
    wide = scratch.keep(sketches(docs, words, percent).withColumn("row", F.monotonically_increasing_id()), "sketches",
                        "zstd")
    slim = scratch.keep(wide.select("row", "doc_id", "text_hash", "n", "fp"), "rows")
    groups = scratch.keep(
        slim.where("n > 0 and doc_id is not null").groupBy("fp")
        .agg(F.min("row").alias("rep"), F.min("doc_id").alias("low"), F.min_by("doc_id", "row").alias("id"),
             F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")), "groups")
    reps = scratch.keep(wide.join(groups.select("rep"), F.col("row") == F.col("rep"), "left_semi")
                        .select(F.col("row").alias("rep"), "n", "ordered", "further", "small"), "representatives", "zstd")
    scratch.drop(wide)
    counts = {r.n: r["count"] for r in groups.where(F.col("n") <= SMALL + 4).groupBy("n").count().collect()}
    limit = boundary(counts, percent)
    subsets = scratch.keep(subset_postings(reps, limit, percent), "subsets")
    smallest = least(limit + 1, percent)
    large = reps.where(F.col("n") >= smallest)
    lists = list_postings(scratch, large.select("rep", F.explode("ordered").alias("key")),
                          large.select("rep", "n", F.size("ordered").alias("m"), "further"), percent)
    scratch.drop(reps)
    scratch.release()
    involved = scratch.keep(shared(lists.unionByName(subsets)), "involved")
    scratch.drop(lists)
    texts = scratch.keep(named_texts(docs, groups.join(involved, "rep", "left_semi").select("rep", "id", "fp"), words), "texts")
    whole = scratch.keep(whole_sets(texts, words, smallest), "sets", "zstd")
    none = F.array().cast("array<long>").alias("further")
    lists = list_postings(
        scratch, whole.select("rep", F.explode("elements").alias("key")),
        groups.where(F.col("n") >= smallest).join(involved, "rep", "left_semi").select("rep", "n", F.col("n").alias("m"), none),
        percent)
    scratch.drop(whole, involved)
    found = links(scratch, texts, lists.unionByName(subsets), words, percent)
    scratch.drop(lists, subsets, texts)
    scratch.release()
    # a component is named by the smallest doc_id of its groups
    placed = groups.join(found, groups["rep"] == found["node"], "left").select("fp", "low", "copies", "component")
    lowest = placed.where("component is not null").groupBy(F.col("component").alias("c")).agg(F.min("low").alias("comp"))
    named = scratch.keep(
        placed.join(lowest, placed["component"] == lowest["c"], "left").where("copies > 1 or component is not null")
        .select("fp", F.coalesce("comp", "low").alias("comp")), "named")
    scratch.drop(groups, found)
    out = slim.select("doc_id", "text_hash", "n", "fp").join(named, "fp", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                      F.when(F.col("n") == 0, F.col("doc_id"))
                      .when(F.col("doc_id").isNull(), F.lit(None))
                      .otherwise(F.coalesce("comp", "doc_id")).cast("long").alias("component_id"), "text_hash")


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words
  from documents),
sets as (
  select doc_id, list_distinct(case when len(words) = 0 then [] when len(words) < 3 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) end) as s
  from w),
items as (select doc_id, len(s) as n, unnest(s) as g from sets),
link as (
  select a.doc_id as a, b.doc_id as b from items a join items b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach as (
  select doc_id as node, doc_id as seen from documents
  union
  select r.node, l.b from reach r join link l on r.seen = l.a)
select sets.doc_id, len(sets.s) as n_shingles, min(reach.seen) as component_id
from sets join reach on reach.node = sets.doc_id group by sets.doc_id, len(sets.s)
"""
