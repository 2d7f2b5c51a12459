"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from oracle.sql import statements, stream_statements
from tidemart.plans import catalog, stream_catalog
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
# Small tables may leave these without rows.
MAY_BE_EMPTY = {"late_audit"}


QUERIES = catalog.registry() | stream_catalog.registry()
SQL = statements() | stream_statements()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    found = difference(QUERIES[name](spark, FOLDER), con,
                       SQL[name])
    if name in MAY_BE_EMPTY and found == "no rows at all":
        found = None
    assert found is None, found


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns[:6] == ["stt", "edt", "vc", "ch", "ar", "is_new"]
    assert result.count() > 0
