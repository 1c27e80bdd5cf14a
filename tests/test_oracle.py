"""Every query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from storelens.catalog import CATALOG
from tests.compare import compare, connect
from tests.conftest import SMALL

QUERIES, ORACLES = {n: entry.queries()[n] for n in CATALOG.queries}, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, ORACLES[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
