"""Every named query against its SQL at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

BASE = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(BASE)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, BASE)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"edge", "key", "window_start", "counter", "cents"}
    assert df.count() > 0
