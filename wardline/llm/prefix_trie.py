"""Conversation prefix trie from sorted LCPs and sparse tables.

Conversations are sorted as sequences of turns (a turn is the 128-bit name of
its role and text; which order the names give is of no matter).  The
conversations with a common prefix then stand side by side, and ``nxt[i]``, the
number of turns that the conversations at i and i + 1 have in common,
says where such intervals end.  For every position i two prefixes are candidates: the
``nxt[i]`` turns it shares with its neighbour, and all its turns.  Each candidate searches
its members by itself, without a stack: to the right the first j >= i with nxt[j] < depth, to
the left the last j < i with nxt[j] < depth, by halving steps over a sparse
table of range minima.  The same interval found twice is one edge of the trie;
it stands for the nodes of all depths from the deeper of its two neighbours' common
prefixes on (exclusive) to its own depth, which have the same members.

At scale: positions are cut into blocks, each with its own sparse table in one
task; block minima, at most ``MAX_BLOCKS``, form a table above them that every
task gets.  A search that leaves its block finds the block where it ends in the
upper table and is finished there, once per distinct depth.  Sorting takes the turns in
chunks (``CHUNK`` at first, twice as many each round): only conversations that are
equal so far go on to the next round, so no row holds a whole long conversation.  Positions and
turn numbers come from one shuffle by ranges, so a conversation or a common opening that holds
a third of the rows is spread over the tasks.

Defined cases: turns are ordered by number (null first), then by name; null role
or text is empty; rows without conv_id are not read; repeated rows are turns
of their own; an empty table gives no nodes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardline.operators.sequence import sequence_within

from .common import Scratch

#: Turns that are compared in the first round, and at most in one.
CHUNK = 16
MAX_CHUNK = 4096
#: Positions of a block at least, and number of blocks at most.
BLOCK = 1024
MAX_BLOCKS = 1 << 16
#: Ids that are joined to one text before they are hashed; depths that are summed together.
JOINED = 1024
NONE = np.iinfo(np.int64).max
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# --- conversations ------------------------------------------------------------------

def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, k (turn from 1), name, words of every turn of ``conversations`` (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
        F.unhex(F.left(F.sha2(whole.cast("binary"), 256), F.lit(32))).alias("name"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return sequence_within(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("name").asc()], "k", {},
                           "long").drop("turn")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, d, name, words: the first h turns of conversation c - c % 20, then c's own after its first h.

    h is crc32 of the decimal c, modulo 4.  Every conversation also has a row of depth 0.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h")
    ids = turns.where("k = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % 20).alias("base"), h)
    first = turns.where("k <= 3 and conv_id % 20 = 0").select(F.col("conv_id").alias("base"), "k", "name", "words")
    opened = first.groupBy("base").agg(F.max("k").alias("have"))
    # places that the turns of a conversation move to the front, as its base has fewer turns than h
    moved = (ids.join(opened, "base", "left")
             .select("conv_id", F.least("h", F.coalesce("have", F.lit(0))).alias("taken"))
             .withColumnRenamed("conv_id", "c"))
    own = (turns.withColumn("h", h).where("k > h").join(moved, F.col("conv_id") == F.col("c"))
           .select("conv_id", (F.col("k") - F.col("h") + F.col("taken")).alias("d"), "name", "words"))
    opening = (ids.join(first, "base").where("k <= h")
               .select("conv_id", F.col("k").alias("d"), "name", "words"))
    none = ids.select("conv_id", F.lit(0).cast("long").alias("d"), F.lit(None).cast("binary").alias("name"),
                      F.lit(0).cast("long").alias("words"))
    return own.union(opening).union(none)


# --- sorted order -------------------------------------------------------------------

def common(a: str, b: str) -> Column:
    """Length of the common prefix of two arrays."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first == 0, F.size(a)).otherwise(first - 1).cast("long")


def chunk_of(turns: DataFrame, after: int, upto: int) -> DataFrame:
    """conv_id, len and the names of the turns after ``after`` up to ``upto``."""
    inside = F.when((F.col("d") > after) & (F.col("d") <= upto), F.struct("d", "name"))
    names = F.transform(F.sort_array(F.collect_list(inside)), lambda t: t["name"])
    return turns.groupBy("conv_id").agg(F.max("d").alias("len"), names.alias("chunk"))


def in_order(scratch: Scratch, turns: DataFrame) -> DataFrame:
    """pos, conv_id, len, nxt for the conversations of ``turns`` (conv_id, d, name), sorted by their turns."""
    after, size, parts = 0, CHUNK, []
    todo = chunk_of(turns, 0, size).select("conv_id", "len", "chunk", F.lit(0).cast("long").alias("rank"),
                                           F.lit(-1).cast("long").alias("exit"))
    while True:
        ordered = sequence_within(todo, "rank", [F.col("chunk").asc(), F.col("conv_id").asc()], "k",
                                  {"next": "chunk"}, "long")
        full = F.size("chunk") == size
        rows = scratch.keep(ordered.select(
            (F.col("rank") + F.col("k") - 1).alias("pos"), "conv_id", "len", "rank", "chunk",
            F.when(F.col("next").isNull(), F.col("exit")).otherwise(after + common("chunk", "next")).alias("nxt"),
            (full & F.coalesce(F.col("chunk") == F.col("next"), F.lit(False))).alias("tied")), f"order{len(parts)}",
            tied=F.count_if("tied"))
        if not rows.measured["tied"]:
            parts.append(rows.select("pos", "conv_id", "len", "nxt"))
            break
        # equal so far: they are sorted again by the turns that follow
        groups = (rows.where(full).groupBy(F.col("rank").alias("r"), F.col("chunk").alias("c"))
                  .agg(F.min("pos").alias("start"), F.max_by("nxt", "pos").alias("last"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1"))
        groups = scratch.keep(groups, "ties")
        met = rows.join(groups, (F.col("rank") == F.col("r")) & (F.col("chunk") == F.col("c")), "left")
        met = scratch.keep(met.select("pos", "conv_id", "len", "nxt", "start", "last"), "placed")
        parts.append(met.where("start is null").select("pos", "conv_id", "len", "nxt"))
        again = met.where("start is not null").select("conv_id", F.col("start").alias("rank"), F.col("last").alias("exit"))
        scratch.drop(rows, groups)
        after, size = after + size, min(2 * size, MAX_CHUNK)
        todo = chunk_of(turns.join(again.select("conv_id"), "conv_id", "left_semi"), after, after + size).join(again, "conv_id")
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


# --- searches -----------------------------------------------------------------------

class Minima:
    """Sparse table: level k has the minimum of the 2**k values that start at each place."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum of the places lo to hi (inclusive); NONE where there are none."""
        out = np.full(len(lo), NONE)
        some = np.flatnonzero(hi >= lo)
        level = np.frexp((hi - lo + 1)[some].astype(float))[1] - 1
        for k in np.unique(level):
            at = some[level == k]
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << k) + 1])
        return out

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First place from ``start`` on whose value is below ``depth``, else the number of values."""
        at, n = start.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(at + (1 << k) <= n)
            go = fits[self.levels[k][at[fits]] >= depth[fits]]
            at[go] += 1 << k
        return at

    def left(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last place before ``start`` whose value is below ``depth``, else -1."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(at >= 1 << k)
            go = fits[self.levels[k][at[fits] - (1 << k)] >= depth[fits]]
            at[go] -= 1 << k
        return at - 1


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


class Order:
    """The sorted conversations in blocks, with the table of block minima."""

    def __init__(self, scratch: Scratch, sequences: DataFrame):
        self.scratch = scratch
        count = sequences.count()
        self.width = max(BLOCK, -(-count // MAX_BLOCKS))
        self.count = count
        self.rows = scratch.keep(sequences.withColumn("block", self.block("pos")), "order")
        tops = self.rows.groupBy("block").agg(F.min("nxt").alias("nxt"), F.min("conv_id").alias("conv")).collect()
        tops.sort(key=lambda r: r.block)
        self.tops = (np.array([r.nxt for r in tops], np.int64), np.array([r.conv for r in tops], np.int64))

    def block(self, pos: str) -> Column:
        return F.floor(F.col(pos) / self.width).cast("long")

    def extents(self, queries: DataFrame) -> DataFrame:
        """The columns of ``queries`` (pos, d, ...) as ``q``, with l, r, conv and lo.

        l to r are the positions of the conversations that share the first d turns of the one at pos,
        ``conv`` is the smallest id among them, and lo - 1 the turns they share with a neighbour.
        """
        width, count, tops = self.width, self.count, self.tops

        def first(key: tuple, asked: pa.Table, block: pa.Table) -> pa.Table:
            """Searches inside the block, then over the block minima."""
            here, base = key[0].as_py(), key[0].as_py() * width
            order = np.argsort(column(block, "pos"))
            nxt, conv = (Minima(column(block, c)[order]) for c in ("nxt", "conv_id"))
            upper, upper_conv = Minima(tops[0]), Minima(tops[1])
            start, d = column(asked, "pos") - base, column(asked, "d")
            size = len(order)
            stop, before = nxt.right(start, d), nxt.left(start, d)
            out_r, out_l = stop == size, before < 0
            blocks = np.full(len(d), here, np.int64)
            to = np.where(out_r, upper.right(blocks + 1, d), -1)
            back = np.where(out_l, upper.left(blocks, d), -1)
            least = conv.least(np.where(out_l, 0, before + 1), np.where(out_r, size - 1, stop))
            least = np.minimum(least, np.where(out_r, upper_conv.least(blocks + 1, np.where(out_r, to, 0) - 1), NONE))
            least = np.minimum(least, np.where(out_l, upper_conv.least(back + 1, blocks - 1), NONE))
            ends = out_r & (to >= len(tops[0]))  # the last conversation of all
            begins = out_l & (back < 0)
            values = nxt.levels[0]
            right = np.where(out_r, count - 1, stop + base)
            left = np.where(out_l, 0, before + 1 + base)
            lcp_r = np.where(out_r, -1, values[np.minimum(stop, size - 1)])
            lcp_l = np.where(out_l, -1, values[np.maximum(before, 0)])
            q = asked.column("q")
            q = q.cast(pa.struct([pa.field(f.name, f.type) for f in q.type]))  # whatever is declared not null
            return pa.table({"q": q, "d": pa.array(d), "conv": pa.array(least),
                             "l": pa.array(left), "r": pa.array(right),
                             "lcp": pa.array(np.maximum(lcp_l, lcp_r)),
                             "back": pa.array(np.where(out_l & ~begins, back, -1)),
                             "to": pa.array(np.where(out_r & ~ends, to, -1))})

        def last(key: tuple, asked: pa.Table, block: pa.Table) -> pa.Table:
            """Where searches that came from other blocks end in this one."""
            base = key[0].as_py() * width
            order = np.argsort(column(block, "pos"))
            nxt, conv = (Minima(column(block, c)[order]) for c in ("nxt", "conv_id"))
            d, rightwards = column(asked, "d"), column(asked, "rightwards") == 1
            size = np.full(len(d), len(order), np.int64)
            at = np.where(rightwards, nxt.right(0 * size, d), nxt.left(size, d))
            least = np.where(rightwards, conv.least(0 * size, at), conv.least(at + 1, size - 1))
            return pa.table({"b": pa.array(np.full(len(d), key[0].as_py(), np.int64)), "e": pa.array(d),
                             "rw": pa.array(rightwards.astype(np.int64)),
                             "end": pa.array(base + at + np.where(rightwards, 0, 1)),
                             "stop": pa.array(nxt.levels[0][at]), "part": pa.array(least)})

        # a column of its own, as a cogroup mixes up columns that both sides have from one table
        named = queries.select(F.struct("*").alias("q"), (F.col("pos") + 0).alias("pos"), (F.col("d") + 0).alias("d"),
                               self.block("pos").alias("block"))
        kind = named.schema["q"].dataType.simpleString()
        found = self.scratch.keep(
            named.groupBy("block").cogroup(self.rows.groupBy("block")).applyInArrow(
                first, f"q {kind}, d long, conv long, l long, r long, lcp long, back long, to long"), "searches",
            open=F.count_if((F.col("back") >= 0) | (F.col("to") >= 0)))
        done = found.where("back < 0 and to < 0")
        done = done.select("q", "l", "r", "conv", (F.col("lcp") + 1).alias("lo"))
        if not found.measured["open"]:
            return done
        open_ = found.where("back >= 0 or to >= 0")
        asked = open_.where("back >= 0").select(F.col("back").alias("block"), "d", F.lit(0).cast("long").alias("rightwards"))
        asked = asked.union(open_.where("to >= 0").select(F.col("to").alias("block"), "d",
                                                          F.lit(1).cast("long").alias("rightwards"))).distinct()
        ends = self.scratch.keep(asked.groupBy("block").cogroup(self.rows.groupBy("block")).applyInArrow(
            last, "b long, e long, rw long, end long, stop long, part long"), "ends")
        for side, at, to in ((0, "back", "l"), (1, "to", "r")):
            answer = ends.where(F.col("rw") == side)
            open_ = open_.join(answer, (F.col(at) == F.col("b")) & (F.col("d") == F.col("e")), "left").select(
                "q", "d", "back", "to", F.least("conv", "part").alias("conv"),
                F.greatest("lcp", "stop").alias("lcp"),
                *[F.coalesce("end", c).alias(c) if c == to else F.col(c) for c in ("l", "r")])
        return done.union(open_.select("q", "l", "r", "conv", (F.col("lcp") + 1).alias("lo")))

    def running(self, values: DataFrame) -> DataFrame:
        """at, and the sums of x and y up to there, for every position of ``values`` (at, x, y; one row each)."""
        blocks = values.groupBy(self.block("at").alias("b")).agg(F.sum("x").alias("bx"), F.sum("y").alias("by"))
        w = W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)  # at most MAX_BLOCKS rows
        before = blocks.select("b", F.coalesce(F.sum("bx").over(w), F.lit(0)).alias("bx"),
                               F.coalesce(F.sum("by").over(w), F.lit(0)).alias("by"))
        inner = W.partitionBy("block").orderBy("at")
        rows = values.withColumn("block", self.block("at")).select(
            "at", "block", F.sum("x").over(inner).alias("x"), F.sum("y").over(inner).alias("y"))
        return rows.join(F.broadcast(before), F.col("block") == F.col("b")).select(
            "at", (F.col("x") + F.col("bx")).cast("long").alias("x"), (F.col("y") + F.col("by")).cast("long").alias("y"))


def hashed_ids(ends: DataFrame) -> DataFrame:
    """l, d and the SHA-256 of the ascending decimal ids, comma-joined, of ``ends`` (l, d, conv_id).

    Ids are joined to texts of ``JOINED`` where they lie, then each group's texts run through one hash.
    """
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # l, d, ids
        for batch in batches:
            out = []
            for l, d, c in zip(*(batch.column(n).to_pylist() for n in ("l", "d", "conv_id"))):
                if held and held[:2] == (l, d) and len(held[2]) < JOINED:
                    held[2].append(c)
                else:
                    if held:
                        out.append(held)
                    held = (l, d, [c])
            yield texts(out)
        if held:
            yield texts([held])

    def texts(groups: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([g[0] for g in groups], pa.int64()), pa.array([g[1] for g in groups], pa.int64()),
             pa.array([g[2][0] for g in groups], pa.int64()),
             pa.array([",".join(map(str, g[2])) for g in groups], pa.string())], names=["l", "d", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha = None, None
        for batch in batches:
            out = []
            for l, d, ids in zip(*(batch.column(n).to_pylist() for n in ("l", "d", "ids"))):
                if held == (l, d):
                    sha.update(b"," + ids.encode())
                else:
                    if held:
                        out.append((*held, sha.hexdigest()))
                    held, sha = (l, d), hashlib.sha256(ids.encode())
            yield digests(out)
        if held:
            yield digests([(*held, sha.hexdigest())])

    def digests(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))],
            names=["sl", "sd", "sha"])

    key = ["l", "d", "conv_id"]
    joined = (ends.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
              .mapInArrow(join, "l long, d long, first long, ids string"))
    return (joined.repartition("l", "d").sortWithinPartitions("l", "d", "first")
            .mapInArrow(digest, "sl long, sd long, sha string"))


# --- nodes --------------------------------------------------------------------------

def prefix_trie(turns: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """All nodes of the trie of ``turns`` (conv_id, d from 0 on without gaps, name, words).

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and left and right, the member interval in the sorted order.
    """
    scratch = scratch or Scratch(turns.sparkSession, "prefix-trie")
    turns = scratch.keep(turns, "turns")
    order = Order(scratch, in_order(scratch, turns))
    rows = order.rows
    own = rows.select("pos", F.col("len").alias("d"), "conv_id", F.lit(True).alias("whole"))
    shared = rows.where("nxt >= 0").select("pos", F.col("nxt").alias("d"), "conv_id", F.lit(False).alias("whole"))
    found = scratch.keep(order.extents(own.union(shared)).select("q.d", "q.conv_id", "q.whole", "l", "r", "conv", "lo"),
                         "found")
    edges = scratch.keep(found.groupBy("l", "r", F.col("d").alias("hi")).agg(
        F.min("conv").alias("conv"), F.min("lo").alias("lo")), "edges")
    above = scratch.keep(
        order.extents(edges.where("lo > 0").select(F.col("l").alias("pos"), (F.col("lo") - 1).alias("d"), "hi"))
        .select(F.col("q.pos").alias("el"), F.col("q.hi").alias("eh"), F.col("q.d").alias("pd"), F.col("l").alias("pl"),
                F.col("conv").alias("parent")), "above")
    kids = above.groupBy("pl", F.col("pd").alias("ph")).agg(F.count(F.lit(1)).alias("kids"))
    edges = (edges.join(above.select("el", "eh", "parent"), (F.col("l") == F.col("el")) & (F.col("hi") == F.col("eh")), "left")
             .join(kids, (F.col("l") == F.col("pl")) & (F.col("hi") == F.col("ph")), "left")
             .select("l", "r", "lo", "hi", "conv", "parent", F.coalesce("kids", F.lit(0)).alias("kids"),
                     (F.col("r") - F.col("l") + 1).alias("n")))
    edges = scratch.keep(edges, "edges")
    # words of the turns of shared edges, from the conversation at their left end
    depths = depths_of(edges.where("n > 1").join(rows.select(F.col("pos").alias("at"), F.col("conv_id").alias("c")),
                                                 F.col("l") == F.col("at")).select("l", "hi", "lo", "n", "c"))
    turn = turns.select(F.col("conv_id").alias("tc"), F.col("d").alias("td"), "words")
    words = scratch.keep(
        depths.join(turn, (F.col("c") == F.col("tc")) & (F.col("depth") == F.col("td")))
        .select("l", "hi", "depth", (F.col("words") * (F.col("n") - 1)).alias("saved")), "words")
    saved = below(words)
    weight = words.groupBy("l", "hi").agg(F.sum("saved").alias("w"))
    weighed = scratch.keep(
        edges.join(weight.withColumnsRenamed({"l": "wl", "hi": "wh"}),
                   (F.col("l") == F.col("wl")) & (F.col("hi") == F.col("wh")), "left")
        .select(*edges.columns, F.coalesce("w", F.lit(0)).alias("w"))
        .withColumn("upto", F.sum("w").over(W.partitionBy("l").orderBy("hi"))), "weighed")
    # sums over the positions: leaves and weights of the edges that begin there
    at = scratch.keep(weighed.groupBy(F.col("l").alias("at")).agg(
        F.count_if(F.col("kids") == 0).alias("x"), F.sum("w").alias("y")), "begins")
    sums = scratch.keep(
        order.running(rows.select(F.col("pos").alias("at")).join(at, "at", "left")
                      .select("at", F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y"))), "sums")
    right = sums.select(F.col("at").alias("rat"), F.col("x").alias("rx"), F.col("y").alias("ry"))
    left = sums.select((F.col("at") + 1).alias("lat"), F.col("x").alias("lx"), F.col("y").alias("ly"))
    whole = (weighed.join(right, F.col("r") == F.col("rat")).join(left, F.col("l") == F.col("lat"), "left")
             .select(*edges.columns, (F.col("rx") - F.coalesce("lx", F.lit(0))).alias("n_leaves"),
                     (F.col("ry") - F.coalesce("ly", F.lit(0)) - F.col("upto")).alias("under")))
    sha = hashed_ids(found.where("whole").select("l", "d", "conv_id"))
    whole = scratch.keep(
        whole.join(sha, (F.col("l") == F.col("sl")) & (F.col("hi") == F.col("sd")), "left").drop("sl", "sd"), "whole")
    nodes = depths_of(whole).join(saved, ["l", "hi", "depth"], "left")
    last = F.col("depth") == F.col("hi")
    return nodes.select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("lo"), F.col("parent")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("kids")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves", (F.col("under") + F.coalesce("rest", F.lit(0))).cast("long").alias("saved_tokens"),
        F.when(last, F.coalesce("sha", F.lit(EMPTY_SHA))).otherwise(EMPTY_SHA).alias("ends_sha256"),
        F.col("l").alias("left"), F.col("r").alias("right"))


def depths_of(edges: DataFrame) -> DataFrame:
    """``edges`` with one row per ``depth`` from lo to hi, dealt out in steps so that no array is long."""
    steps = edges.withColumn("step", F.explode(F.sequence("lo", "hi", F.lit(JOINED).cast("long"))))
    return steps.withColumn("depth", F.explode(F.sequence("step", F.least(F.col("step") + (JOINED - 1), F.col("hi"))))).drop("step")


def below(words: DataFrame) -> DataFrame:
    """l, hi, depth, rest: what is saved on the edge from ``depth`` on; summed in two levels."""
    part = F.floor(F.col("depth") / JOINED).alias("part")
    inner = W.partitionBy("l", "hi", "part").orderBy(F.desc("depth"))
    rows = words.withColumn("part", part).withColumn("rest", F.sum("saved").over(inner))
    parts = words.groupBy("l", "hi", part).agg(F.sum("saved").alias("s"))
    after = W.partitionBy("l", "hi").orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col("l").alias("pl"), F.col("hi").alias("ph"), F.col("part").alias("pp"),
                         F.sum("s").over(after).alias("more")).where("more > 0")
    return rows.join(parts, (F.col("l") == F.col("pl")) & (F.col("hi") == F.col("ph")) & (F.col("part") == F.col("pp")),
                     "left").select("l", "hi", "depth", (F.col("rest") + F.coalesce("more", F.lit(0))).alias("rest"))


def conversation_trie(conversations: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The trie of the rebuilt ``conversations`` (conv_id, turn, role, text)."""
    scratch = scratch or Scratch(conversations.sparkSession, "prefix-trie")
    return prefix_trie(rebuilt(scratch.keep(turns_of(conversations), "own")), scratch).drop("left", "right")


ORACLE = r"""
with recursive t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as k
  from conversations where conv_id is not null),
bytes as (  -- crc32 by its definition: one step per bit
  select conv_id, cast(conv_id as varchar) as s, 0 as i, 4294967295::ubigint as crc from (select distinct conv_id from t)
  union all
  select conv_id, s, i + 1, list_reduce(
      list_prepend(xor(crc, ord(s[i + 1])::ubigint), list_transform(range(8), lambda b: b::ubigint)),
      lambda c, b: xor(c >> 1, (c & 1) * 3988292384::ubigint)) as crc
  from bytes where i < length(s)),
ids as (select conv_id, conv_id - conv_id % 20 as base, (xor(crc, 4294967295::ubigint) % 4)::bigint as h
        from bytes where i = length(s)),
rebuilt as (
  select conv_id, row_number() over (partition by conv_id order by part, k) as d, role, text from (
    select i.conv_id, 0 as part, t.k, t.role, t.text from ids i join t on t.conv_id = i.base and t.k <= i.h
    union all
    select i.conv_id, 1, t.k, t.role, t.text from ids i join t on t.conv_id = i.conv_id and t.k > i.h)),
prefixes as (
  select conv_id, d, text, list(sha256(length(role) || ':' || role || text))
    over (partition by conv_id order by d) as path from rebuilt
  union all select conv_id, 0, '', []::varchar[] from ids),
lens as (select conv_id, max(d) as len from prefixes group by conv_id),
node as (
  select path, p.d as depth, min(p.conv_id) as conv_id, count(*) as n_convs,
    any_value(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))) as words,
    sha256(coalesce(string_agg(case when len = p.d then cast(p.conv_id as varchar) end, ',' order by p.conv_id), '')) as ends_sha256
  from prefixes p join lens on lens.conv_id = p.conv_id group by path, p.d),
kids as (select path[:depth - 1] as path, count(*) as n from node where depth > 0 group by 1),
flagged as (
  select node.*, coalesce(kids.n, 0) as n_children, case when kids.n is null then 1 else 0 end as leaf,
    case when depth > 0 then (n_convs - 1) * words else 0 end as saved
  from node left join kids on kids.path = node.path),
up as (
  select unnest(list_transform(range(0, depth + 1), lambda i: path[:i])) as path, leaf, saved from flagged),
sums as (select path, sum(leaf) as n_leaves, sum(saved) as saved_tokens from up group by path)
select f.conv_id, f.depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children,
  sums.n_leaves::bigint as n_leaves, sums.saved_tokens::bigint as saved_tokens, f.ends_sha256
from flagged f join sums on sums.path = f.path
left join node p on f.depth > 0 and p.path = f.path[:f.depth - 1]
"""
