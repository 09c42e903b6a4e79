"""Data-quality checks as distributed queries.

A check is a declarative spec (like a schema test in YAML).  ``failures``
turns it into a DataFrame of failing values with their row counts:
``(check_name, failing_value, n_records)``; ``run_checks`` reduces a list
of checks to one report row each.  Failure counts follow the usual test
semantics: ``unique`` and ``accepted_values`` count distinct failing
values, the other generic checks count failing rows, singular checks
count returned rows.  NULL passes ``accepted_values`` and
``accepted_range``; ``relationships`` ignores NULL child keys.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.operators.joins import bounded_broadcast
from wardline.session import ensure_checkpoint_dir

@dataclass(frozen=True)
class Check:
    kind: str                     # unique | not_null | accepted_values | relationships | accepted_range | singular
    model: str
    column: str | None = None
    severity: str = "error"       # error | warn
    values: tuple = ()            # accepted_values
    to: str | None = None         # relationships: parent model
    field: str | None = None      # relationships: parent column
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    name_override: str | None = None

    @property
    def name(self) -> str:
        if self.name_override:
            return self.name_override
        suffix = f"_{self.to}_{self.field}" if self.kind == "relationships" else ""
        return f"{self.kind}_{self.model}_{self.column}{suffix}"


# --- generic checks: failing rows -------------------------------------------

def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with their counts."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside ``values`` (compared as strings), with counts."""
    as_text = F.col(column).cast("string")
    return (df.filter(as_text.isNotNull() & ~as_text.isin([str(v).lower() if isinstance(v, bool) else str(v)
                                                            for v in values]))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (anti join)."""
    keys = parent.select(F.col(parent_column).alias("_parent_key"))
    c = child.filter(F.col(column).isNotNull())
    return c.join(keys, c[column] == keys["_parent_key"], "left_anti")


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent and their row counts: ``(column, n_records)``.

    Child rows are counted per key first (partial aggregation), so only one
    row per distinct key reaches the anti join: a key shared by a large
    share of the rows does not make the join skewed.  The join is an outer one
    with a filter: a left_anti join the optimizer moves below the count where
    the parent keys look small, and then every child row is shuffled and sorted.
    """
    per_key = (child.filter(F.col(column).isNotNull()).groupBy(column)
               .agg(F.count(F.lit(1)).alias("n_records")))
    keys = parent.select(F.col(parent_column).alias("_parent_key")).distinct()
    return (per_key.join(keys, per_key[column] == keys["_parent_key"], "left")
            .filter(keys["_parent_key"].isNull()).drop("_parent_key"))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None,
                   inclusive: bool = True) -> DataFrame:
    """Rows outside [min, max] (either bound optional); NULL passes."""
    c = F.col(column)
    conds = []
    if min_value is not None:
        conds.append(c >= min_value if inclusive else c > min_value)
    if max_value is not None:
        conds.append(c <= max_value if inclusive else c < max_value)
    if not conds:
        return df.limit(0)
    ok = reduce(lambda a, b: a & b, conds)
    return df.filter(~ok)


# --- singular checks --------------------------------------------------------

def overlap_rate(readmissions: DataFrame, threshold: float = 0.10) -> DataFrame:
    """One row (total, overlapping, pct) when overlapping stays exceed ``threshold``."""
    stats = readmissions.agg(
        F.count(F.lit(1)).alias("total_stays"),
        F.count_if(F.col("overlaps_next_stay")).alias("overlapping_stays"))
    rate = F.try_divide(F.col("overlapping_stays").cast("double"),
                        F.nullif(F.col("total_stays"), F.lit(0)).cast("double"))
    return (stats.withColumn("_rate", rate).filter(F.col("_rate") > threshold)
            .select("total_stays", "overlapping_stays", F.round(F.col("_rate") * 100, 1).alias("overlap_pct")))


def seed_coverage(encounters: DataFrame, seed: DataFrame) -> DataFrame:
    """Inpatient encounter codes missing from the seed (no code at all is missing too), with their occurrences.

    Encounters are counted per (code, description) with partial aggregation in
    one scan; the totals per code are summed over those few rows.
    """
    pairs = (encounters.filter(F.col("encounter_class") == "inpatient")
             .groupBy("encounter_code", "encounter_description").agg(F.count(F.lit(1)).alias("n"))
             .join(bounded_broadcast(seed).select("encounter_code"), "encounter_code", "left_anti"))
    return pairs.select("encounter_code", "encounter_description",
                        F.sum("n").over(Window.partitionBy("encounter_code")).alias("occurrences"))


def unplanned_lte_allcause(kpis: DataFrame) -> DataFrame:
    """Organizations whose unplanned rate exceeds the all-cause rate."""
    return (kpis.filter(F.col("readmission_rate_30d_unplanned_pct") > F.col("readmission_rate_30d_pct"))
            .select("organization_id", "readmission_rate_30d_pct", "readmission_rate_30d_unplanned_pct"))


# --- spec -> failures ---------------------------------------------------------

def checkpointed(relation: "Resolver", columns: dict[str, set[str]] | None = None,
                 enabled: bool = True) -> "Resolver":
    """Resolver that materializes each relation once (reliable checkpoint).

    A suite runs many checks over the same models; checking views would
    recompute every model once per check inside one very large plan.
    ``checkpoint()`` writes the relation to the shared checkpoint folder
    (surviving executor loss) and cuts its lineage, so each check plans
    and scans a small table.  With ``enabled=False`` relations are only
    pruned (for views that are already cheap scans of columnar tables).
    """
    done: dict[str, DataFrame] = {}
    lock = threading.Lock()

    def resolve(name: str) -> DataFrame:
        with lock:
            if name in done:
                return done[name]
        df = relation(name)
        if columns and name in columns:
            df = df.select(*sorted(columns[name]))
        if enabled:
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint(eager=True)
        with lock:
            return done.setdefault(name, df)

    return resolve


Resolver = Callable[[str], DataFrame]


def failures(check: Check, relation: Resolver) -> DataFrame:
    """Failing values of ``check`` as ``(check_name, failing_value, n_records)``."""
    name = F.lit(check.name)
    df = relation(check.model)
    col = check.column
    if check.kind == "unique":
        out = unique(df, col).select(name.alias("check_name"), F.col(col).cast("string").alias("failing_value"),
                                     "n_records")
    elif check.kind == "accepted_values":
        out = accepted_values(df, col, check.values).select(
            name.alias("check_name"), F.col(col).cast("string").alias("failing_value"), "n_records")
    elif check.kind == "relationships":
        out = (orphan_keys(df, col, relation(check.to), check.field)
               .select(name.alias("check_name"), F.col(col).cast("string").alias("failing_value"), "n_records"))
    elif check.kind in ("not_null", "accepted_range"):
        bad = (not_null(df, col) if check.kind == "not_null"
               else accepted_range(df, col, check.min_value, check.max_value, check.inclusive))
        out = (bad.agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 0)
               .select(name.alias("check_name"), F.lit(None).cast("string").alias("failing_value"), "n_records"))
    elif check.kind == "singular":
        bad = SINGULAR[check.name](relation)
        out = (bad.agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 0)
               .select(name.alias("check_name"), F.lit(None).cast("string").alias("failing_value"), "n_records"))
    else:
        raise ValueError(f"unknown check kind {check.kind!r}")
    return out.select(F.col("check_name"), F.col("failing_value"), F.col("n_records").cast("long"))


def failures_of(checks: Iterable[Check], relation: Resolver) -> DataFrame:
    """Union of the failing values of several checks."""
    frames = [failures(c, relation) for c in checks]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _sql_text(v) -> str:
    text = str(v).lower() if isinstance(v, bool) else str(v)
    return "'" + text.replace("'", "''") + "'"


def _row_level_sql(view: str, checks: Sequence[Check]) -> str:
    """All row-level checks of one model as one aggregation over ``view``.

    ``not_null`` and ``accepted_range`` count failing rows; ``accepted_values``
    counts distinct failing values (NULL passes both value checks).
    """
    exprs = []
    for i, c in enumerate(checks):
        col = f"`{c.column}`"
        if c.kind == "not_null":
            e = f"count_if({col} is null)"
        elif c.kind == "accepted_range":
            conds = []
            if c.min_value is not None:
                conds.append(f"{col} {'>=' if c.inclusive else '>'} {c.min_value}")
            if c.max_value is not None:
                conds.append(f"{col} {'<=' if c.inclusive else '<'} {c.max_value}")
            e = f"count_if(not ({' and '.join(conds)}))" if conds else "0"
        else:
            allowed = ", ".join(_sql_text(v) for v in c.values)
            e = (f"count(distinct case when {col} is not null and cast({col} as string) not in ({allowed}) "
                 f"then cast({col} as string) end)")
        exprs.append(f"cast({e} as bigint) as c{i}")
    pairs = ", ".join(f"{_sql_text(c.name)}, c{i}" for i, c in enumerate(checks))
    return (f"select stack({len(checks)}, {pairs}) as (check_name, failures) "
            f"from (select {', '.join(exprs)} from {view})")


def _failure_counts(checks: Sequence[Check], relation: Resolver) -> tuple[DataFrame, list[str]]:
    """``(check_name, failures)`` for every check, and the temporary views it uses.

    The generic checks are rendered as one SQL statement over temporary views
    of the checked relations (one plan, analysed once): per model one
    aggregation for all row-level checks, one grouped count per ``unique``
    column, and per ``relationships`` check the child rows counted per key
    before the join (one row per distinct key meets the parent keys; see ``orphan_keys``).
    Singular checks are DataFrame queries counted alongside.
    """
    views: dict[str, str] = {}
    spark = None

    def view(model: str) -> str:
        nonlocal spark
        if model not in views:
            df = relation(model)
            spark = df.sparkSession
            views[model] = f"_wl_check_{model}_{uuid.uuid4().hex[:8]}"
            df.createOrReplaceTempView(views[model])
        return views[model]

    parts: list[str] = []
    by_model: dict[str, list[Check]] = {}
    singular: list[Check] = []
    for c in checks:
        name, col = _sql_text(c.name), f"`{c.column}`" if c.column else None
        if c.kind in ("not_null", "accepted_range", "accepted_values"):
            by_model.setdefault(c.model, []).append(c)
        elif c.kind == "unique":
            parts.append(f"select {name} as check_name, count(*) as failures from (select {col} from "
                         f"{view(c.model)} where {col} is not null group by {col} having count(*) > 1) d")
        elif c.kind == "relationships":
            parts.append(f"select {name} as check_name, coalesce(sum(k.n), 0) as failures from "
                         f"(select {col} as key, count(*) as n from {view(c.model)} where {col} is not null "
                         f"group by {col}) k left join (select distinct `{c.field}` as pk from "
                         f"{view(c.to)}) p on k.key = p.pk where p.pk is null")
        elif c.kind == "singular":
            singular.append(c)
        else:
            raise ValueError(f"unknown check kind {c.kind!r}")
    for model, cs in by_model.items():
        parts.append(_row_level_sql(view(model), cs))
    frames = []
    if parts:
        frames.append(spark.sql(" union all ".join(
            f"select check_name, cast(failures as bigint) as failures from ({p}) q{i}"
            for i, p in enumerate(parts))))
    for c in singular:
        frames.append(SINGULAR[c.name](relation).agg(F.count(F.lit(1)).cast("long").alias("failures"))
                      .select(F.lit(c.name).alias("check_name"), "failures"))
    return reduce(lambda a, b: a.unionByName(b), frames), list(views.values())


def check_failure_counts(checks: Sequence[Check], relation: Resolver) -> DataFrame:
    """``(check_name, failures)`` for every check, as one lazy plan."""
    return _failure_counts(checks, relation)[0]


def models_of(check: Check) -> set[str]:
    """Every model a check reads."""
    if check.kind == "relationships":
        return {check.model, check.to}
    if check.kind == "singular":
        return set(SINGULAR_COLUMNS[check.name])
    return {check.model}


def collect_failure_counts(checks: Sequence[Check], relation: Resolver) -> dict[str, int]:
    """Run ``checks`` now and return ``{check_name: failures}`` (one small row per check)."""
    if not checks:
        return {}
    df, views = _failure_counts(checks, relation)
    try:
        return {r["check_name"]: int(r["failures"] or 0) for r in df.collect()}
    finally:
        for v in views:
            df.sparkSession.catalog.dropTempView(v)


def run_checks(spark: SparkSession, checks: Sequence[Check], relation: Resolver | None,
               counts: dict[str, int] | None = None) -> DataFrame:
    """One report row per check: name, kind, model, column, severity, failures, status.

    Status is ``pass`` without failures, else ``warn`` for warn checks and
    ``fail`` for error checks; warnings never stop a run.
    """
    spec = spark.createDataFrame(
        [(c.name, c.kind, c.model, c.column, c.severity) for c in checks],
        "check_name string, kind string, model string, column_name string, severity string")
    if counts is None:
        counts_df = check_failure_counts(checks, relation)
    else:
        counts_df = spark.createDataFrame([(k, v) for k, v in counts.items()],
                                          "check_name string, failures long")
    counts = counts_df
    n = F.coalesce(F.col("failures"), F.lit(0)).cast("long")
    return (spec.join(F.broadcast(counts), "check_name", "left")
            .select("check_name", "kind", "model", "column_name", "severity", n.alias("failures"),
                    F.when(n == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
                    .alias("status")))


def columns_needed(checks: Sequence[Check]) -> dict[str, set[str]]:
    """Columns each model must expose for ``checks`` (for pruned materialization)."""
    need: dict[str, set[str]] = {}
    for c in checks:
        if c.column:
            need.setdefault(c.model, set()).add(c.column)
        if c.kind == "relationships":
            need.setdefault(c.to, set()).add(c.field)
        if c.kind == "singular":
            for m, cols in SINGULAR_COLUMNS[c.name].items():
                need.setdefault(m, set()).update(cols)
    return need


def raise_on_errors(report: DataFrame) -> None:
    """Fail a run when an error-severity check failed (warnings are reported only)."""
    bad = report.filter(F.col("status") == "fail").select("check_name", "failures").collect()
    if bad:
        raise AssertionError("data-quality errors: " + ", ".join(f"{r[0]}={r[1]}" for r in bad))


SINGULAR_COLUMNS: dict[str, dict[str, set[str]]] = {
    "assert_overlap_rate_within_bounds": {"fct_readmissions": {"overlaps_next_stay"}},
    "assert_seed_covers_inpatient_codes": {
        "fct_encounters": {"encounter_class", "encounter_code", "encounter_description"},
        "seed_encounter_planned_classification": {"encounter_code"}},
    "assert_unplanned_rate_lte_allcause": {
        "mart_organization_kpis": {"organization_id", "readmission_rate_30d_pct",
                                   "readmission_rate_30d_unplanned_pct"}},
}

SINGULAR: dict[str, Callable[[Resolver], DataFrame]] = {
    "assert_overlap_rate_within_bounds": lambda rel: overlap_rate(rel("fct_readmissions")),
    "assert_seed_covers_inpatient_codes": lambda rel: seed_coverage(
        rel("fct_encounters"), rel("seed_encounter_planned_classification")),
    "assert_unplanned_rate_lte_allcause": lambda rel: unplanned_lte_allcause(rel("mart_organization_kpis")),
}
