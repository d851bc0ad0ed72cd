"""Every query of the engine against its SQL in DuckDB, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["complaint_category", "total_calls", "backlog_count", "failure_pct", "failure_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    assert difference(spark, SF_DIR, name, duck) is None
