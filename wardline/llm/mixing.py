"""Mixing sources to target weights by iterative proportional fitting (raking).

Documents fall into cells (source, language, topic).  The tokens of all
documents are summed per cell, then the cells' weights are scaled to each
marginal in turn - sources, languages, topics - until all three hold at once.
Targets that cannot hold together (a language found in one source only, with
more than that source's target) are met as far as weights within ``BOUND`` of the
product of the targets allow: no cell falls to zero, the categories that miss
their target are in ``Mix.missed``, in a warning, and ``on_target`` of the rows.
A document is kept with its cell's calibrated probability, decided by a hash of
its doc_id, so the expected tokens of the sample have the target marginals.

Targets are shares per category.  Where none are given, a category's target is
its share of all tokens to the power ``TEMPER``, made to add up to one, which
lifts rare categories.  Every source and language is a category of its own: up
to ``DRIVER_CELLS`` cells are raked by the driver, more as a sparse table by grouped
sums and joins, written after each axis.  Only if ``max_categories`` is given, the
sources (or languages) beyond those with the most tokens form one more stratum,
whose target is the sum of theirs; no document is left out of the fit.  Probabilities are
the weights times one factor, at most 1, so that a share ``budget`` of all tokens
is expected to be kept (``BUDGET`` if none is asked for): cells whose weight asks
for more than there is are kept whole, and no rare cell decides how much of the
others stays.  Only with explicit targets and no budget the sample is the largest
that has exactly these targets.  Nothing is repeated.

Defined cases: null text counts as empty (no tokens); a null source or language
is the category ''; a document without words has topic t0; a row without doc_id
is decided by its text.  Repeated rows share a decision.  Other
columns pass through ``keep`` untouched.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import Scratch, small_batches

TEMPER = 0.8
#: More cells than this are raked as a table, and joined with the documents; fewer are held by the driver and workers.
DRIVER_CELLS = 200_000
TOPICS = 5
LONG_WORD = 8
OTHER = "\x00other"
SEED = 11
WORD_MEMORY = 300_000
AXES = ("source", "lang", "topic")
MORE = [f"m_{n}" for n in AXES] + ["m_n", "m_chance"]
ROUNDS, TOLERANCE = 500, 1e-10
TABLE_ROUNDS = 100
#: Share of all tokens that is kept with the default targets.
BUDGET = 0.8
#: Raked targets count as met within ``CLOSE``; a cell ``FAR`` below the product of its targets, or targets that are
#: not met, let the raking start anew with its part of every weight held within ``BOUND``; ``MISS`` is reported.
CLOSE, FAR, BOUND, MISS = 1e-4, 100.0, 10.0, 0.01


def topic_of(words: list[str], known: dict[str, int]) -> str:
    """The topic that most long words (if there are none, words) hash to; ties go to the smaller number."""
    votes = [0] * TOPICS
    for w in [w for w in words if len(w) >= LONG_WORD] or words:
        t = known.get(w)
        if t is None:
            if len(known) >= WORD_MEMORY:
                known.clear()
            t = known[w] = xxhash.xxh3_64_intdigest(w.lower()) % TOPICS
        votes[t] += 1
    return f"t{votes.index(max(votes))}"


def features(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens of every row of ``docs`` (doc_id, text, lang, source)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            topics, counts = [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").split()
                topics.append(topic_of(words, known))
                counts.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("source").fill_null(""),
                 batch.column("lang").fill_null(""), pa.array(topics, pa.string()), pa.array(counts, pa.int64())],
                names=["doc_id", "source", "lang", "topic", "n_tokens"])

    return docs.select("doc_id", "text", "source", "lang").mapInArrow(
        run, "doc_id long, source string, lang string, topic string, n_tokens long")


def rake_cells(codes: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray],
               rounds: int = ROUNDS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Weights of cells (their category on each axis, their tokens), and the sums of each category by its target.

    A weight is the product of target / share over the axes, times one fitted
    factor per category.  Where the targets cannot hold together, or only with a
    cell close to zero, the fitted part of every weight is held within ``BOUND``,
    so every cell whose targets are positive keeps a positive weight.
    """
    total = tokens.sum()
    sums = [np.bincount(c, tokens, len(t)) for c, t in zip(codes, targets)]
    first = np.ones(len(tokens))
    for c, t, s in zip(codes, targets, sums):
        first *= np.divide(t * total, s, out=np.zeros(len(t)), where=s > 0)[c]

    def reached(weights: np.ndarray, axis: int) -> np.ndarray:
        goal = targets[axis] * total
        return np.divide(np.bincount(codes[axis], tokens * weights, len(goal)), goal, out=np.ones(len(goal)), where=goal > 0)

    for bound in (np.inf, BOUND):
        factors = [np.ones(len(t)) for t in targets]
        weights = first
        for _ in range(rounds):
            before = weights
            for axis in range(len(codes)):
                have = reached(weights, axis)
                factors[axis] = np.clip(factors[axis] / np.where(have > 0, have, 1.0), bound ** -2, bound ** 2)
                fitted = np.ones(len(tokens))
                for c, f in zip(codes, factors):
                    fitted *= f[c]
                weights = first * np.clip(fitted, 1 / bound, bound)
            if (np.abs(weights - before) <= TOLERANCE * before).all():
                break
        ratios = [reached(weights, axis) for axis in range(len(codes))]
        if max(float(np.abs(r - 1).max(initial=0.0)) for r in ratios) < CLOSE and (weights * FAR >= first).all():
            break
    return weights, ratios


def rake(tokens: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS) -> np.ndarray:
    """``rake_cells`` for a full table of tokens; empty cells get weight 0."""
    at = np.nonzero(tokens)
    out = np.zeros(tokens.shape)
    out[at] = rake_cells(list(at), tokens[at].astype(float), targets, rounds)[0]
    return out


@dataclass
class Mix:
    """Calibrated weight and probability of every cell."""
    axes: tuple[list[str], list[str], list[str]] = ((), (), ())
    weights: dict[tuple[str, str, str], float] = field(default_factory=dict)
    scale: float = 0.0
    #: (axis, category): share of its target that the weights reach, where the targets cannot hold together
    missed: dict[tuple[str, str], float] = field(default_factory=dict)
    #: source, lang, topic, weight, on_target of the cells where they are too many for ``weights``
    table: DataFrame | None = None

    def __post_init__(self) -> None:
        self.strata = [frozenset(a) for a in self.axes]

    def cell(self, source: str | None, lang: str | None, topic: str) -> tuple[str, ...]:
        return tuple(v if v in s else OTHER for v, s in zip((source or "", lang or "", topic), self.strata))

    def weight(self, cell: tuple[str, str, str]) -> float:
        return self.weights.get(cell, 0.0)

    def on_target(self, cell: tuple[str, str, str]) -> bool:
        """Whether the weights meet the targets of all three categories."""
        return not self.missed or not any(k in self.missed for k in zip(AXES, cell))

    def probability(self, cell: tuple[str, str, str]) -> float:
        """Chance of being kept; a cell without tokens has nothing to weigh and is kept."""
        return min(1.0, self.scale * self.weights[cell]) if cell in self.weights else 1.0



def fit(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: float = TEMPER,
        budget: float | None = None, max_categories: int | None = None, driver_cells: int = DRIVER_CELLS) -> Mix:
    """Rake the token counts of all of ``docs`` to ``targets`` {"source"|"lang"|"topic": {category: share}}."""
    budget = BUDGET if budget is None and not targets else budget
    scratch = Scratch(docs.sparkSession, "mixing")
    sums = features(docs).groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    sums = scratch.keep(sums, "cells", cells=F.count(F.lit(1)))
    names = list(AXES)
    if max_categories is None and (sums.measured["cells"] or 0) > driver_cells:
        return _fit_table(scratch, sums, targets or {}, temper, budget)
    rows = sums.collect() if max_categories is None else None  # bounded by driver_cells
    axes, given = [], dict(targets or {})
    for n in names:
        if max_categories is None:
            axes.append(sorted({r[n] for r in rows}) + [OTHER])
            continue
        top = (sums.groupBy(n).agg(F.sum("tokens").alias("t")).orderBy(F.desc("t"), n).limit(max_categories).collect())
        axes.append(sorted(r[n] for r in top) + [OTHER])
        if given.get(n):  # the stratum of the others has the sum of the targets that occur among them
            rest = sums.select(n).where(F.col(n).isin(list(set(given[n]) - set(axes[-1])))).distinct().collect()
            given[n] = given[n] | {OTHER: sum(given[n][r[0]] for r in rest)}
    if max_categories is None:
        cells = rows
    else:
        folded = sums.select(*[F.when(F.col(n).isin(a[:-1]), F.col(n)).otherwise(F.lit(OTHER)).alias(n)
                               for n, a in zip(names, axes)], "tokens")
        cells = folded.groupBy(*names).agg(F.sum("tokens").alias("tokens")).collect()  # bounded by max_categories
    scratch.drop(sums)
    at = [{v: i for i, v in enumerate(a)} for a in axes]
    codes = [np.array([at[k][r[n]] for r in cells], dtype=np.int64) for k, n in enumerate(names)]
    tokens = np.array([r.tokens for r in cells], dtype=float)
    if not len(cells):
        return Mix()
    wanted = []
    for c, n, a in zip(codes, names, axes):
        share = np.bincount(c, tokens, len(a)) / tokens.sum()
        asked = given.get(n)
        goal = np.array([asked.get(v, 0.0) for v in a]) * (share > 0) if asked else share ** temper
        wanted.append(goal / goal.sum())
    weights, reached = rake_cells(codes, tokens, wanted)
    missed = {(n, v): float(x) for n, a, ratios in zip(names, axes, reached) for v, x in zip(a, ratios)
              if abs(x - 1) > MISS}
    if missed:
        worst = sorted(missed.items(), key=lambda m: -abs(m[1] - 1))[:5]
        warnings.warn(f"mixing: the targets of {len(missed)} categories cannot hold together with the others; "
                      f"reached shares of the targets: {worst}", stacklevel=2)
    return Mix(tuple(axes), {(r.source, r.lang, r.topic): float(w) for r, w in zip(cells, weights)},
               scale_for(tokens, weights, budget), missed)


def _fit_table(scratch: Scratch, cells: DataFrame, targets: dict, temper: float, budget: float | None) -> Mix:
    """``fit`` for cells that do not fit into the driver: the same raking, each sum and each factor a grouped join."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("tokens")).first()[0])
    current = cells
    for n in AXES:
        goals = current.groupBy(n).agg(F.sum("tokens").cast("double").alias("t"))
        if targets.get(n):
            asked = spark.createDataFrame([(k, float(v)) for k, v in targets[n].items()], f"{n} string, asked double")
            goals = goals.join(asked, n, "left").select(n, "t", F.coalesce("asked", F.lit(0.0)).alias("goal"))
        else:
            goals = goals.withColumn("goal", F.pow(F.col("t") / total, F.lit(temper)))
        goals = scratch.keep(goals, "goals", all=F.sum("goal"))
        goal = F.col("goal") / goals.measured["all"] * total
        nxt = scratch.keep(current.join(goals.select(n, goal.alias(f"g_{n}"), (goal / F.col("t")).alias(f"r_{n}")), n),
                           "cells")
        scratch.drop(goals, current)
        current = nxt
    first = F.col(f"r_{AXES[0]}") * F.col(f"r_{AXES[1]}") * F.col(f"r_{AXES[2]}")
    current = current.select(*AXES, "tokens", *[f"g_{n}" for n in AXES], first.alias("first"))
    source = nxt
    for bound in (None, BOUND):
        fitted = F.col(f"f_{AXES[0]}") * F.col(f"f_{AXES[1]}") * F.col(f"f_{AXES[2]}")
        held = fitted if bound is None else F.greatest(F.least(fitted, F.lit(bound)), F.lit(1 / bound))
        weight = F.col("first") * held
        raked = scratch.keep(current.select("*", *[F.lit(1.0).alias(f"f_{n}") for n in AXES]), "raked")
        for _ in range(TABLE_ROUNDS):
            off = 0.0
            for n in AXES:
                have = raked.groupBy(n).agg(F.sum(F.col("tokens") * weight).alias("have"))
                new = F.when(F.col("have") > 0, F.col(f"f_{n}") * F.col(f"g_{n}") / F.col("have")).otherwise(F.col(f"f_{n}"))
                if bound is not None:
                    new = F.greatest(F.least(new, F.lit(bound ** 2)), F.lit(bound ** -2))
                moved = F.abs(F.col(f"f_{n}") / F.col("before") - 1)
                stepped = scratch.keep(
                    raked.join(have, n).withColumn("before", F.col(f"f_{n}")).withColumn(f"f_{n}", new).drop("have"),
                    "raked", off=F.max(moved))
                off = max(off, stepped.measured["off"] or 0.0)
                scratch.drop(raked)
                back = stepped.drop("before")
                back._scratch = stepped._scratch
                raked = back
            if off < CLOSE:
                break
        ratio = F.when(F.col("goal") > 0, F.col("have") / F.col("goal")).otherwise(1.0)
        done = raked.select(*AXES, "tokens", "first", *[f"g_{n}" for n in AXES], weight.alias("weight"))
        for n in AXES:
            have = raked.groupBy(n).agg(F.sum(F.col("tokens") * weight).alias("have"), F.first(f"g_{n}").alias("goal"))
            done = done.join(have.select(n, ratio.alias(f"x_{n}")), n)
        away = F.greatest(*[F.abs(F.col(f"x_{n}") - 1) for n in AXES])
        out = scratch.keep(
            done.select(*AXES, "tokens", "weight", (away <= MISS).alias("on_target"), away.alias("away"), "first"), "weights",
            away=F.max("away"), low=F.min(F.when(F.col("first") > 0, F.col("weight") / F.col("first"))),
            missed=F.count_if(~F.col("on_target")), heaviest=F.max("weight"),
            lightest=F.min(F.when(F.col("weight") > 0, F.col("weight"))))
        scratch.drop(raked)
        if out.measured["away"] < 10 * CLOSE and out.measured["low"] * FAR >= 1 or bound is not None:
            break
        scratch.drop(out)
    scratch.drop(source)
    if out.measured["missed"]:
        warnings.warn(f"mixing: the targets cannot hold together in {out.measured['missed']} cells; the farthest is "
                      f"{out.measured['away']:.3g} of its target away", stacklevel=3)
    scale = 1.0 / out.measured["heaviest"]
    if budget is not None:
        lo, hi = scale / 2 ** 10, 1.0 / out.measured["lightest"]
        for _ in range(6):  # each pass over the cells narrows the factor 64-fold
            steps = np.geomspace(lo, hi, 65)
            kept = out.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * float(x))) for x in steps]).first()
            at = next((i for i, k in enumerate(kept) if k > budget * total), len(steps) - 1)
            lo, hi = float(steps[max(at - 1, 0)]), float(steps[at])
        scale = hi
    return Mix(scale=scale, table=out.select(*AXES, "weight", "on_target"))


def _joined(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` with m_source, m_lang, m_topic, m_n, m_chance and the weight, probability and on_target of the cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            topics, counts, chances = [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py()
                words = (text or "").split()
                topics.append(topic_of(words, known))
                counts.append(len(words))
                chances.append(chance(doc_id.as_py(), text))
            more = [batch.column("source").fill_null(""), batch.column("lang").fill_null(""),
                    pa.array(topics, pa.string()), pa.array(counts, pa.int64()), pa.array(chances, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *MORE])

    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(MORE, ("string", "string", "string", "long", "double")):
        schema = schema.add(name, kind)
    known = mix.table.select(*[F.col(n).alias(f"w_{n}") for n in AXES], "weight", F.col("on_target").alias("met"))
    same = [F.col(f"m_{n}") == F.col(f"w_{n}") for n in AXES]
    chanced = docs.mapInArrow(run, schema).join(known, same[0] & same[1] & same[2], "left")
    return chanced.withColumn("probability", F.when(F.col("weight").isNull(), 1.0).otherwise(
        F.least(F.lit(1.0), F.col("weight") * mix.scale)))


def scale_for(tokens: np.ndarray, weights: np.ndarray, budget: float | None) -> float:
    """The factor from weights to probabilities: the largest with none above one, or the one that meets ``budget``."""
    whole = 1.0 / weights.max()
    if budget is None:
        return whole
    lo, hi = 0.0, 1.0 / weights[weights > 0].min()
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if (tokens * np.minimum(1, mid * weights)).sum() > budget * tokens.sum() else (mid, hi)
    return hi


def chance(doc_id: int | None, text: str | None) -> float:
    """A document's number in [0, 1)."""
    key = (text or "").encode("utf-8", "surrogatepass") if doc_id is None else int(doc_id).to_bytes(8, "little", signed=True)
    return (xxhash.xxh3_64_intdigest(key, seed=SEED) >> 11) / 2.0 ** 53


def _decided(batch: pa.RecordBatch, mix: Mix, known: dict[str, int]) -> list[tuple]:
    out = []
    for doc_id, text, source, lang in zip(*(batch.column(c) for c in ("doc_id", "text", "source", "lang"))):
        text, doc_id = text.as_py(), doc_id.as_py()
        words = (text or "").split()
        topic = topic_of(words, known)
        cell = mix.cell(source.as_py(), lang.as_py(), topic)
        p = mix.probability(cell)
        out.append((doc_id, source.as_py(), lang.as_py(), topic, len(words), round(mix.weight(cell), 9), round(p, 9),
                    mix.on_target(cell), chance(doc_id, text) < p))
    return out


def decide(docs: DataFrame, mix: Mix) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, on_target, kept for every row of ``docs``."""
    if mix.table is not None:
        return _joined(docs.select("doc_id", "text", "source", "lang"), mix).select(
            F.col("doc_id").cast("long"), "source", "lang", F.col("m_topic").alias("topic"), F.col("m_n").alias("n_tokens"),
            F.round(F.coalesce("weight", F.lit(0.0)), 9).alias("weight"), F.round("probability", 9).alias("probability"),
            F.coalesce("met", F.lit(True)).alias("on_target"), (F.col("m_chance") < F.col("probability")).alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.bool_(),
                 pa.bool_()]
        names = ["doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "on_target", "kept"]
        for batch in batches:
            rows = _decided(batch, mix, known)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                             names=names)

    return docs.select("doc_id", "text", "source", "lang").mapInArrow(
        run, "doc_id long, source string, lang string, topic string, n_tokens long, weight double, "
             "probability double, on_target boolean, kept boolean")


def keep(docs: DataFrame, mix: Mix, columns: list[str]) -> DataFrame:
    """The sampled rows of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            yield batch.filter(pa.array([r[-1] for r in _decided(batch, mix, known)], pa.bool_()))

    small_batches(docs.sparkSession)
    picked = docs.select(*columns)
    if mix.table is not None:
        return _joined(picked, mix).where("m_chance < probability").select(*columns)
    return picked.mapInArrow(run, picked.schema)
