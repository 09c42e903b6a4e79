"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades are ordered (0 none, 1 toxic, 2 toxic in text of low quality, as the
labels give them).  One weight per feature is shared by all thresholds:
``P(grade >= k) = sigmoid(w . x - t_k)`` with ``t_1 <= t_2 <= ...``; the output
is the expected grade.  Words and word beginnings that stand in a text are its
features, each with two values: 1, and ``log1p(RATE * count / (words + 20))``,
so that a hit in a long text can weigh less than in a short one.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, those
with the smallest hash of doc_id) and at most ``FEATURES`` features: those whose
share of documents differs between toxic and other ones by at least ``LEAST_Z``
standard errors.  Scoring reads every row and whole text.

Defined cases: null text counts as empty and scores by the thresholds alone; a
row without label is only scored; a label that is null is not used; without
labels of both kinds, or without features that tell them apart, nothing is
toxic.  Repeated rows are scored each, other columns
are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

SAMPLE_ROWS = 20_000
FEATURES = 3_000
MIN_ROWS, LEAST_Z = 6, 5.0
#: Chance of a grade above none from which a text counts as toxic.
TOXIC = 0.4
RATE = 200.0
WORD_MEMORY = 300_000
LETTERS = re.compile(r"[^\W\d_]+")


def word_features(raw: str) -> list[str]:
    """Features of one space-separated word: its runs of letters and their beginnings."""
    out = []
    for w in LETTERS.findall(raw.lower()):
        out.append(w)
        out += [f"^{w[:k]}" for k in range(4, 8) if len(w) >= k]
    return out


@dataclass
class Model:
    index: dict[str, int] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=lambda: [8.0])
    known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def hits(self, text: str) -> tuple[Counter, int]:
        """Counts of the model's features in a whole text, and its number of words."""
        words, known, index = text.split(), self.known, self.index
        found: list[tuple[int, ...]] = []
        for w in words:
            f = known.get(w)
            if f is None:
                f = tuple(index[x] for x in word_features(w) if x in index)
                if len(w) <= 64:
                    if len(known) >= WORD_MEMORY:
                        known.clear()
                    known[w] = f
            if f:
                found.append(f)
        return Counter(i for f in found for i in f), len(words)

    def score(self, text: str) -> float:
        counts, n = self.hits(text)
        return sum(self.weights[2 * i] + self.weights[2 * i + 1] * math.log1p(RATE * c / (n + 20))
                   for i, c in sorted(counts.items()))

    def probabilities(self, score: float) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        return [1 / (1 + math.exp(-max(-50.0, min(50.0, score - t)))) for t in self.thresholds]


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, grades: np.ndarray, n_features: int,
                top: int, ridge: float = 0.02, steps: int = 400, rate: float = 0.1) -> tuple[list, list]:
    """Shared weights and ordered thresholds of a cumulative-link model, by full-batch Adam.

    Every threshold is a logistic regression of ``grade >= k`` on the same
    weights; the gaps between thresholds are exp(g), hence positive.
    """
    n = len(grades)
    share = min(max((grades >= 1).mean(), 1 / (n + 1)), 1 - 1 / (n + 1))
    theta = np.zeros(n_features + top)
    theta[n_features] = -math.log(share / (1 - share))
    above = np.stack([(grades >= k).astype(float) for k in range(1, top + 1)], 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w = theta[:n_features]
        gaps = np.exp(theta[n_features + 1:])
        cuts = theta[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(rows, vals * w[cols], n)
        p = 1 / (1 + np.exp(-np.clip(z[:, None] - cuts, -50, 50)))
        d = (p - above) / n
        gw = np.bincount(cols, vals * d.sum(1)[rows], n_features) + ridge / n * 50 * w
        dc = -d.sum(0)
        tail = np.cumsum(dc[::-1])[::-1]
        gt = np.concatenate([[tail[0]], tail[1:] * gaps + 0.001 * theta[n_features + 1:]])
        g = np.concatenate([gw, gt])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    gaps = np.exp(theta[n_features + 1:])
    return theta[:n_features].tolist(), (theta[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])).tolist()


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, n_features: int = FEATURES) -> Model:
    """Fit on at most ``sample_rows`` labelled documents: labels (doc_id, quality, toxic), docs (doc_id, text)."""
    graded = (labels.where("doc_id is not null and toxic is not null")
              .groupBy("doc_id").agg(F.max(F.when(F.col("toxic") == 0, 0)
                                           .when(F.coalesce("quality", F.lit(1)) == 0, 2).otherwise(1)).alias("grade")))
    sample = (graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
              .select(F.col("doc_id").alias("l_doc"), "grade"))
    picked = sample.toPandas()  # at most sample_rows pairs of integers
    if not len(picked) or not (picked["grade"] > 0).any():
        return Model()
    spark = docs.sparkSession
    ids = F.broadcast(spark.createDataFrame(picked, "l_doc long, grade int"))
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("l_doc")).select("doc_id", "grade", "text")

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: Counter = Counter()
        for batch in batches:
            for text, grade in zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist()):
                for f in {f for w in set((text or "").split()) for f in word_features(w)}:
                    by[f, grade > 0] += 1
            if len(by) > 500_000:
                yield _counts(by)
                by.clear()
        yield _counts(by)

    totals = texts.groupBy((F.col("grade") > 0).alias("t")).count().collect()
    n1 = sum(r["count"] for r in totals if r.t)
    n0 = sum(r["count"] for r in totals if not r.t)
    if not n1 or not n0:
        return Model()
    stats = (texts.select("text", "grade").mapInArrow(seen, "feature string, toxic boolean, n long")
             .groupBy("feature").agg(F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("a"),
                                     F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("b"))
             .where(F.col("a") + F.col("b") >= MIN_ROWS))
    lift = F.col("a") / F.lit(n1) - F.col("b") / F.lit(n0)
    pooled = (F.col("a") + F.col("b") + 1) / F.lit(n1 + n0 + 2)
    error = F.sqrt(pooled * (1 - pooled) * F.lit(1 / n1 + 1 / n0))
    chosen = (stats.withColumn("s", F.abs(lift) / error).where(F.col("s") >= LEAST_Z)
              .orderBy(F.desc("s"), "feature").limit(n_features).select("feature").collect())
    if not chosen:
        return Model()
    model = Model({r.feature: i for i, r in enumerate(sorted(chosen))}, [0.0] * 2 * len(chosen))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, val = [], []
            for text in batch.column("text").to_pylist():
                counts, n = model.hits(text or "")
                items = sorted(counts.items())
                idx.append([j for i, _ in items for j in (2 * i, 2 * i + 1)])
                val.append([v for _, c in items for v in (1.0, math.log1p(RATE * c / (n + 20)))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("grade"), pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float64())),
                 batch.column("doc_id").cast(pa.int64())], names=["grade", "idx", "val", "doc_id"])

    data = (texts.select("doc_id", "text", "grade")
            .mapInArrow(vectors, "grade int, idx array<int>, val array<double>, doc_id long").toArrow())
    model.known.clear()
    grades, rows, cols, vals = design(data)
    model.weights, model.thresholds = fit_ordinal(rows, cols, vals, grades, 2 * len(model.index), 2)
    return model


def design(data: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Grades, and row, column and value of every entry, of rows (grade, idx, val, doc_id) in an order that does not depend on partitions."""
    ids, grades = data.column("doc_id").to_numpy(), data.column("grade").to_numpy()
    order = np.lexsort((grades, ids))
    edges = np.flatnonzero(np.diff(ids[order]) | np.diff(grades[order])) + 1
    idx, val = data.column("idx"), data.column("val")
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(order)]):
        if b - a > 1:  # rows of one doc_id and grade: by what they hold
            order[a:b] = sorted(order[a:b].tolist(), key=lambda i: (idx[i].as_py(), val[i].as_py()))
    data = data.take(pa.array(order)).combine_chunks()
    idx, val = data.column("idx").combine_chunks(), data.column("val").combine_chunks()
    rows = np.repeat(np.arange(len(order)), pc.list_value_length(idx).to_numpy())
    return grades[order], rows, idx.flatten().to_numpy().astype(int), val.flatten().to_numpy().astype(float)


def _counts(by: Counter) -> pa.RecordBatch:
    keys = list(by)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
         pa.array([by[k] for k in keys], pa.int64())], names=["feature", "toxic", "n"])


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, severity (expected grade), p_toxic, toxic for every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py() or "") for t in batch.column("text")]
            probs = [model.probabilities(s) for s in scores]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([round(s, 6) for s in scores], pa.float64()),
                 pa.array([round(sum(p), 6) for p in probs], pa.float64()),
                 pa.array([round(p[0], 6) for p in probs], pa.float64()),
                 pa.array([p[0] >= TOXIC for p in probs], pa.bool_())],
                names=["doc_id", "score", "severity", "p_toxic", "toxic"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, severity double, p_toxic double, toxic boolean")


def keep_clean(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The rows of ``docs`` that are not toxic, in one pass over the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [model.probabilities(model.score(t.as_py() or ""))[0] < TOXIC for t in batch.column("text")]
            yield batch.filter(pa.array(clean, pa.bool_()))

    small_batches(docs.sparkSession)
    picked = docs.select(*columns)
    return picked.mapInArrow(run, picked.schema)
