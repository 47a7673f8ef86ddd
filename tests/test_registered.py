"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks import registry
from tests.oracle_compare import compare, open_tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    problem, _, _ = compare(spark, db, name, QUERIES[name], ORACLES[name], FOLDER)
    assert problem is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "score"]
