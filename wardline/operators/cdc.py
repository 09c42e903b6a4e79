"""Change capture between two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, DELETE = "INSERT", "DELETE"


def snapshot_diff(prev: DataFrame, curr: DataFrame, key: str,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that changed from ``prev`` to ``curr`` with ``cdc_action`` / ``cdc_is_update``.

    A key only in ``curr`` is an INSERT, only in ``prev`` a DELETE; a key in
    both whose compared columns differ (NULL-safe) becomes a DELETE of the
    old row and an INSERT of the new one, both with ``cdc_is_update``
    true.  Unchanged rows produce nothing.  Non-NULL keys must be unique in
    each snapshot: a key that a snapshot holds twice aborts the job (use
    ``multiset_diff`` for keyless tables).  One full outer join, on sides that
    are aggregated by the same key; each joined row is expanded in place.
    """
    cols = [c for c in (columns or curr.columns) if c != key]
    out_cols = [key, *cols]
    # A NULL key never matches: such rows are a DELETE (previous) or an INSERT
    # (current) outright.  Keeping them out of the join avoids hashing all of
    # them into one reducer.
    unmatched = (prev.filter(F.col(key).isNull()).select(*out_cols, F.lit(DELETE).alias("cdc_action"),
                                                         F.lit(False).alias("cdc_is_update"))
                 .unionByName(curr.filter(F.col(key).isNull())
                              .select(*out_cols, F.lit(INSERT).alias("cdc_action"),
                                      F.lit(False).alias("cdc_is_update"))))
    p = _by_key(prev, key, out_cols).alias("p")
    c = _by_key(curr, key, out_cols).alias("c")
    j = p.join(c, F.col(f"p.{key}") == F.col(f"c.{key}"), "full_outer")
    in_p, in_c = F.col("p._present").isNotNull(), F.col("c._present").isNotNull()
    same = reduce(lambda a, b: a & b, [F.col(f"p.{x}").eqNullSafe(F.col(f"c.{x}")) for x in cols], F.lit(True))
    updated = in_p & in_c & ~same

    def image(side: str, action: str, when):
        return F.when(when, F.struct(*[F.col(f"{side}.{x}").alias(x) for x in out_cols],
                                     F.lit(action).alias("cdc_action"), updated.alias("cdc_is_update")))

    changes = F.array(image("p", DELETE, in_p & (~in_c | updated)), image("c", INSERT, in_c & (~in_p | updated)))
    return j.select(F.inline(F.filter(changes, lambda x: x.isNotNull()))).unionByName(unmatched)


def _by_key(snapshot: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The rows with a key, one per key; a repeated key raises when the row is read."""
    rows = (snapshot.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.any_value(F.struct(*columns)).alias("_row"), F.count(F.lit(1)).alias("_n")))
    message = F.concat(F.lit(f"snapshot holds {key} "), F.col(key).cast("string"), F.lit(" more than once"))
    present = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    # the grouping key itself, so that the join needs no second shuffle
    return rows.select(*[F.col(key) if x == key else F.col(f"_row.`{x}`").alias(x) for x in columns], present.alias("_present"))


def multiset_diff(prev: DataFrame, curr: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Diff of keyless tables: per distinct row, how many copies were inserted or deleted.

    Returns the row's columns, ``cdc_action`` and ``cdc_rows`` (copies).
    Copies of ``curr`` count 1 and those of ``prev`` -1 in one partial aggregation,
    so the rows are shuffled once and many copies of one row never meet in one task.
    """
    cols = list(columns or curr.columns)
    row = F.struct(*[F.col(x) for x in cols]).alias("_row")
    both = (curr.select(row, F.lit(1).cast("long").alias("_n"))
            .unionByName(prev.select(row, F.lit(-1).cast("long").alias("_n"))))
    return (both.groupBy("_row").agg(F.sum("_n").alias("_d")).filter(F.col("_d") != 0)
            .select("_row.*", F.when(F.col("_d") > 0, INSERT).otherwise(DELETE).alias("cdc_action"),
                    F.abs(F.col("_d")).alias("cdc_rows")))
