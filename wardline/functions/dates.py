"""Calendar differences that count *boundaries crossed*.

The warehouse models measure durations with a cross-engine ``datediff``
macro whose result is the number of unit boundaries between two stamps
(00:00:59 -> 00:01:00 is one minute, 23:00 -> 01:00 the next day is one
day, 2019-12-31 -> 2020-01-01 is one year).  Spark's ``timestampdiff``
counts whole elapsed units instead, so the boundary form is written out
from wall-clock parts.  Working on wall-clock parts keeps the result
independent of the session time zone for TIMESTAMP_NTZ inputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_between(start, end) -> Column:
    """Day boundaries from ``start`` to ``end`` (BIGINT, NULL-propagating)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start))).cast("long")


def minutes_between(start, end) -> Column:
    """Minute boundaries from ``start`` to ``end`` (BIGINT)."""
    s, e = _c(start), _c(end)
    minute_of_day = lambda c: F.hour(c) * 60 + F.minute(c)
    return (days_between(s, e) * 1440
            + (minute_of_day(e) - minute_of_day(s)).cast("long"))


def years_between(start, end) -> Column:
    """Year boundaries from ``start`` to ``end``: birthdays are ignored (BIGINT)."""
    return (F.year(_c(end)) - F.year(_c(start))).cast("long")
