"""Every named query against its SQL, on the smallest tables."""

import os

import pytest
from oracle import compare, connect, repo

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# Queries of the optional part are tested beside it.
NAMES = [n for group in (repo.reports, repo.quality, repo.loads, repo.ingest, repo.streams) for n in group.QUERIES]


def test_each_query_has_sql():
    assert set(NAMES) <= set(repo.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) == ""


def test_entry(spark):
    assert repo.entry(spark).count() == 5
