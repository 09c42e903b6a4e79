"""Embedding near-dedup with spherical-cap filters.

Filter directions form product codes: the space is rotated and cut into two
blocks, each block has a list of random unit vectors, and a direction is a
choice of one per block.  A vector is listed under every direction whose cap it
lies in (cosine at least ``alpha``); the list is decoded from the block products
by pairing only those that together exceed the threshold, so the code is never
enumerated.  ``CODES`` independent codes are used, since the directions of one
share their blocks.  Vectors that share a direction are joined, pairs whose
128-bit sign sketches are too far apart for the threshold (by more than five
standard deviations) are left out, and the exact cosine decides.

``alpha`` and the size of the codes follow from the number of distinct vectors
by the distribution of random directions on the sphere: a cap holds at most
about ``LOAD`` unrelated vectors, and two vectors at the threshold share about
``SHARED`` of at least ``LEAST`` directions (short vectors, of fewer than 16
dimensions, have one block).  Every vector is listed; there is no limit on lists
or partners.  Recall against brute force is measured in the tests.

Equal vectors are represented by their smallest vec_id and counted.

Defined cases: a vector that is null, zero, empty or holds null or non-finite
components links with nothing (its component is its own vec_id); only vectors
of equal length are compared; labels and other columns are not read; repeated
rows are vectors of their own, linked with each other; a row without vec_id
takes part in no link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components

COSINE = 0.9
LOAD, SHARED, LEAST = 10.0, 30.0, 16_384
CODES = 4
SEED = 20240607
GRID = np.linspace(-1.0, 1.0, 20_001)


@lru_cache(maxsize=64)
def tails(dim: int) -> np.ndarray:
    """P(cosine with a random direction >= x) for x in GRID."""
    density = np.maximum(1 - GRID ** 2, 0) ** ((dim - 3) / 2)
    mass = np.concatenate([[0.0], np.cumsum((density[1:] + density[:-1]) / 2)])
    return np.maximum(mass[-1] - mass, 0) / mass[-1]


def both(alpha: float, cosine: float, dim: int) -> float:
    """P(a random direction has at least ``alpha`` with both of two vectors at ``cosine``)."""
    x = np.linspace(alpha, 1, 2001)[:-1]
    need = (alpha - cosine * x) / np.sqrt((1 - cosine ** 2) * (1 - x ** 2))
    share = np.interp(np.clip(need, -1, 1), GRID, tails(dim - 1))
    mass = -np.diff(np.interp(np.append(x, 1.0), GRID, tails(dim)))
    return float((mass * share).sum())


@lru_cache(maxsize=64)
def plan(n: int, cosine: float, dim: int) -> tuple[float, float]:
    """Cosine of the caps and number of directions for ``n`` distinct vectors."""
    lo, hi = 0.0, 0.95
    for _ in range(50):
        mid = (lo + hi) / 2
        more = np.interp(mid, GRID, tails(dim)) * n > LOAD or SHARED / both(mid, cosine, dim) < LEAST
        lo, hi = (mid, hi) if more else (lo, mid)
    return hi, SHARED / both(hi, cosine, dim)


@lru_cache(maxsize=64)
def code(dim: int, n: int, cosine: float, number: int) -> tuple[np.ndarray, list[np.ndarray], float]:
    """Rotation, the unit vectors of each block and the caps' cosine, the same on every machine."""
    rng = np.random.default_rng([SEED, dim, number])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    if dim < 16:  # one block, a cap for each of about 60 / CODES nearest directions
        size = max(8, min(16_384, 32 * 4 ** (dim - 1)) // CODES)
        w = rng.standard_normal((size, dim))
        w /= np.linalg.norm(w, axis=1, keepdims=True)
        test = rng.standard_normal((200, dim))
        test /= np.linalg.norm(test, axis=1, keepdims=True)
        return rotation, [w], float(np.quantile(w @ test.T, 1 - min(60 // CODES, size // 4) / size)) - 1e-9
    alpha, directions = plan(n, cosine, dim)
    words = []
    for width in (dim // 2, dim - dim // 2):
        w = rng.standard_normal((math.ceil(math.sqrt(directions / CODES)), width))
        # a direction's block has the share of its length that the block has of the space
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True) * math.sqrt(width / dim))
    return rotation, words, alpha


def decode(unit: np.ndarray, n: int, cosine: float, number: int) -> Iterator[np.ndarray]:
    """For every row of ``unit`` the directions (integers) of one code whose cap holds it."""
    rotation, words, alpha = code(unit.shape[1], n, cosine, number)
    turned, width = unit @ rotation, words[0].shape[1]
    lefts = turned[:, :width] @ words[0].T
    if len(words) == 1:
        yield from (np.flatnonzero(row >= alpha) for row in lefts)
        return
    rights = turned[:, width:] @ words[1].T
    for left, right in zip(lefts, rights):
        keep_l = np.flatnonzero(left >= alpha - right.max())
        keep_r = np.flatnonzero(right >= alpha - left.max())
        order = keep_r[np.argsort(-right[keep_r], kind="stable")]
        counts = np.searchsorted(-right[order], left[keep_l] - alpha, side="right")
        firsts = np.repeat(keep_l, counts)
        runs = np.arange(len(firsts)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield firsts * len(right) + order[runs]


def sketches(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 signs of random projections as two integers for each row."""
    rng = np.random.default_rng([SEED, unit.shape[1], 999])
    bits = (unit @ rng.standard_normal((unit.shape[1], 128)) >= 0)
    words = np.packbits(bits, axis=1).view(np.int64)
    return words[:, 0], words[:, 1]


def farthest(cosine: float) -> int:
    """Signs that may differ at the threshold: five standard deviations over their mean."""
    p = math.acos(cosine) / math.pi
    return math.ceil(128 * p + 5 * math.sqrt(128 * p * (1 - p)))


def postings(reps: DataFrame, n: int, cosine: float) -> DataFrame:
    """dim, cap, rep, s, t for every direction whose cap holds the representative ``rep``; s, t its sign sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("rep").to_numpy()
            lists = batch.column("embedding")
            sizes = np.asarray(lists.value_lengths())
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = np.stack([lists[int(i)].values.to_numpy() for i in at]).astype(float)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                caps, owners = [], []
                for number in range(CODES):
                    for i, found in enumerate(decode(x, n, cosine, number)):
                        caps.append(found * CODES + number)
                        owners.append(np.full(len(found), i))
                caps, owners = np.concatenate(caps), np.concatenate(owners)
                s, t = sketches(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(caps), dim, np.int32)), pa.array(caps.astype(np.int64)),
                     pa.array(ids[at][owners]), pa.array(s[owners]), pa.array(t[owners])],
                    names=["dim", "cap", "rep", "s", "t"])

    return reps.select("rep", "embedding").mapInArrow(run, "dim int, cap long, rep long, s long, t long")


def verified(pairs: DataFrame, reps: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) whose cosine, in double precision, reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            sizes = np.asarray(x.value_lengths())
            keep = np.zeros(len(batch), bool)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                u, v = (np.stack([c[int(i)].values.to_numpy() for i in at]).astype(float) if len(np.unique(sizes)) > 1
                        else c.flatten().to_numpy().astype(float).reshape(len(batch), dim) for c in (x, y))
                u, v = (w / np.abs(w).max(axis=1, keepdims=True) for w in (u, v))
                dots = np.einsum("ij,ij->i", u, v)
                keep[at] = dots / np.sqrt(np.einsum("ij,ij->i", u, u) * np.einsum("ij,ij->i", v, v)) >= cosine
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = reps.select(F.col("rep").alias("a"), F.col("embedding").alias("x"))
    right = reps.select(F.col("rep").alias("b"), F.col("embedding").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, scratch: Scratch | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding)."""
    scratch = scratch or Scratch(vectors.sparkSession, "embedding")
    rows = vectors.select("vec_id", "embedding")
    usable = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    good = rows.where(usable)
    reps = scratch.keep(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
                        "representatives")
    caps = scratch.keep(postings(reps, reps.count(), cosine), "caps")
    other = caps.select("dim", "cap", F.col("rep").alias("b"), F.col("s").alias("u"), F.col("t").alias("v"))
    apart = F.bit_count(F.col("s").bitwiseXOR(F.col("u"))) + F.bit_count(F.col("t").bitwiseXOR(F.col("v")))
    pairs = (caps.withColumnRenamed("rep", "a").join(other, ["dim", "cap"])
             .where((F.col("a") < F.col("b")) & (apart <= farthest(cosine))).select("a", "b"))
    pairs = scratch.keep(pairs.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "pairs")
    linked = scratch.keep(verified(pairs, reps, cosine), "links")
    scratch.drop(caps, pairs)
    both = linked.union(linked.select("b", "a"))
    copies = reps.select(F.col("rep").alias("b"), "copies")
    degrees = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others"))
    found = components(scratch, linked)
    named = scratch.keep(
        reps.join(degrees, reps["rep"] == degrees["a"], "left").join(found, reps["rep"] == found["node"], "left")
        .select("embedding", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")), "named")
    out = (good.join(named, "embedding").select("vec_id", "n_links", "component_id")
           .union(rows.where(~F.coalesce(usable, F.lit(False)))
                  .select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))))
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"),
                      F.col("component_id").cast("long").alias("component_id"),
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (
  select a.vec_id as a, b.vec_id as b from v a join v b
    on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (
  select vec_id as node, vec_id as seen from embeddings
  union
  select r.node, l.b from reach r join link l on r.seen = l.a),
comp as (select node, min(seen) as component_id from reach group by node),
deg as (select a, count(*) as n from link group by a)
select e.vec_id, coalesce(d.n, 0) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join comp c on c.node = e.vec_id left join deg d on d.a = e.vec_id
"""
