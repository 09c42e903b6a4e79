"""Business expressions reused across models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six age bands and their exclusive upper bounds, in order.
# A NULL or any age of 80 or more falls in the last band.
AGE_BANDS = ["00-17", "18-34", "35-49", "50-64", "65-79", "80+"]
_AGE_UPPER = [18, 35, 50, 65, 80]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def age_band(age) -> Column:
    """Six-band age bucket; a NULL age lands in ``80+`` like the macro's ELSE."""
    age = _c(age)
    expr = None
    for upper, label in zip(_AGE_UPPER, AGE_BANDS):
        cond = age < upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(AGE_BANDS[-1]))


def safe_div(num, den) -> Column:
    """``num / nullif(den, 0)`` as DOUBLE (no division-by-zero error under ANSI)."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den), F.lit(0)).cast("double"))


def pct(num, den, scale: int = 2) -> Column:
    """Percentage rounded to ``scale`` places; DOUBLE arithmetic, NULL on a zero base."""
    return F.round(F.lit(100.0) * safe_div(num, den), scale)


def count_true(cond) -> Column:
    """``sum(case when cond then 1 else 0 end)`` as BIGINT."""
    return F.sum(F.when(_c(cond), F.lit(1)).otherwise(F.lit(0))).cast("long")


# Amounts are summed with six decimals and rounded once, at the end.
AMOUNT = "decimal(28,6)"


def money_sum(amount, scale: int = 2) -> Column:
    """Exact sum of amounts, rounded once, returned as DOUBLE.

    Summing doubles depends on addition order, which differs between tasks
    and engines; a decimal sum is the same under any partitioning.
    """
    return F.round(F.sum(_c(amount).cast(AMOUNT)), scale).cast("double")


def money_avg(amount, scale: int = 2) -> Column:
    """Average of amounts from the exact decimal sum, rounded, DOUBLE."""
    total = F.sum(_c(amount).cast(AMOUNT)).cast("double")
    return F.round(F.try_divide(total, F.count(_c(amount)).cast("double")), scale)
