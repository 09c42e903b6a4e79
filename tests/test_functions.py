import datetime as dt

from pyspark.sql import functions as F

from wardline.functions import age_band, days_between, minutes_between, money_sum, pct, years_between


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_minutes_count_boundaries(spark):
    rows = [(dt.datetime(2020, 1, 1, 0, 0, 59), dt.datetime(2020, 1, 1, 0, 1, 0)),
            (dt.datetime(2020, 1, 1, 10, 0, 0), dt.datetime(2020, 1, 1, 10, 0, 0)),
            (dt.datetime(2020, 1, 1, 23, 59, 0), dt.datetime(2020, 1, 2, 0, 1, 30)),
            (None, dt.datetime(2020, 1, 1))]
    got = _one(spark, minutes_between("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz")
    assert got == [1, 0, 2, None]


def test_days_and_years_count_boundaries(spark):
    rows = [(dt.datetime(2020, 1, 1, 23, 0), dt.datetime(2020, 1, 2, 1, 0))]
    assert _one(spark, days_between("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz") == [1]
    rows = [(dt.date(2019, 12, 31), dt.date(2020, 1, 1)), (dt.date(2000, 6, 1), dt.date(2010, 5, 1))]
    assert _one(spark, years_between("a", "b"), rows, "a date, b date") == [1, 10]


def test_age_band_edges(spark):
    rows = [(None,), (-3,), (17,), (18,), (34,), (35,), (49,), (50,), (64,), (65,), (79,), (80,), (120,)]
    got = _one(spark, age_band("a"), rows, "a bigint")
    assert got == ["80+", "00-17", "00-17", "18-34", "18-34", "35-49", "35-49", "50-64", "50-64",
                   "65-79", "65-79", "80+", "80+"]


def test_pct_zero_base_is_null(spark):
    got = _one(spark, pct(F.col("n"), F.col("d")), [(1, 3), (1, 0), (0, 5)], "n bigint, d bigint")
    assert got == [33.33, None, 0.0]


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "x double")
    assert df.agg(money_sum("x")).first()[0] == 3.0
