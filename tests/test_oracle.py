"""Every registered query against its SQL on the small tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry
from lexspark.plans.catalog import CATALOG

ROOT = os.environ.get("TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.database(ROOT)


def test_every_query_has_sql():
    assert all(query.sql for query in CATALOG.values())
    assert set(CATALOG) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], ROOT) > 0
