"""Property checks of the boundary differences against a plain-Python definition."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from wardline.functions import days_between, minutes_between, years_between

stamps = st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 12, 31))


def _minute_floor(t: dt.datetime) -> dt.datetime:
    return t.replace(second=0, microsecond=0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(stamps, stamps), min_size=50, max_size=200))
def test_boundaries_match_definition(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(minutes_between("a", "b").alias("m"), days_between("a", "b").alias("d"),
                    years_between("a", "b").alias("y")).collect()
    for (a, b), r in zip(pairs, got):
        assert r["m"] == (_minute_floor(b) - _minute_floor(a)) // dt.timedelta(minutes=1)
        assert r["d"] == (b.date() - a.date()).days
        assert r["y"] == b.year - a.year
