"""Every registered query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from wheelhouse import catalog
from tests.compare import DATA, connect, differences

FOLDER = str(DATA / "sf0.001")
# The text operators have tests of their own.
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, ORACLES[name]) == []


def test_entry_gives_rows(spark):
    result = entry_points.entry(spark)
    assert result.count() > 0
    assert result.columns[0] == "ride_id"
