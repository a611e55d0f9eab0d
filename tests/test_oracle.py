"""Every registered query against its DuckDB SQL on the smallest tables, and
the DataFrame-built input views against the fixture SQL statements."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from claimlake.plans import queries as own
from claimlake.plans.oracle import VIEW_SQL, with_views
from claimlake.sources import claims_view as cv
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(round(v, 9))
        return v.isoformat() if hasattr(v, "isoformat") else str(v)
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


def _compare(df, rel):
    s_cols, d_cols = df.columns, rel.columns
    assert sorted(s_cols) == sorted(d_cols)
    s_rows = [tuple(r) for r in df.collect()]
    d_rows = rel.fetchall()
    assert len(s_rows) == len(d_rows)
    assert _canon(s_cols, s_rows) == _canon(d_cols, d_rows)


@pytest.mark.parametrize("name", sorted(own.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = own.queries()[name](spark, SF_SMALL)
    _compare(df, con.sql(own.oracle_sql()[name]))


def test_every_query_has_an_oracle():
    assert set(own.queries()) == set(own.oracle_sql())
    assert set(own.queries()) <= set(entry.queries())


@pytest.mark.parametrize("view", sorted(VIEW_SQL))
def test_views_match_fixture_sql(spark, con, view):
    df = cv.VIEWS[view](spark, SF_SMALL)
    _compare(df, con.sql(with_views(f"select * from {view}", view)))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["MARKET_NAME", "merged_pat_ref", "merged_prod_ref", "n_claims", "total_quantity"]
    assert df.count() > 0
    assert os.path.isdir(entry.SMOKE_DIR)
