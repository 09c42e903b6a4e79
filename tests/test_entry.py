import duckdb
import pytest

import __spark_entry__ as E
from wardline.registry import QUERIES
from wardline.sources.testdata import TEST_TABLES

from conftest import SF_SMALL

OWN = sorted(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "readmission_rate_30d_pct" in df.columns


def test_every_query_has_an_oracle_or_is_streaming():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(OWN) <= set(o)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", OWN)
def test_matches_oracle_small(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)

    def canon(rows, cols):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        out = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in idx) for r in rows]
        return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(cur.fetchall(), dcols)
