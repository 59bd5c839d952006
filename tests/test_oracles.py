"""Every registered query against its SQL on the shared tables."""

import os

import pytest

import __spark_entry__ as entry
from streambed.catalog import oracles, queries
from tests.compare import difference, duck
from tests.conftest import SMALL

SF_DIR = os.environ.get("STREAMBED_SF_DIR", SMALL)
ORACLES = oracles.SQL
QUERIES = queries.REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql_or_is_known_not_to():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
