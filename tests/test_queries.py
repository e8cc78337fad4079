"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
from compare import database, differences

from __spark_entry__ import entry, oracle_sql, queries
from millrace.checks import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert differences(queries()[name](spark, SF), db, oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0
