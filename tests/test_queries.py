"""Every registered query next to its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, duck
from showcase import ENTRIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name) == ""


def test_every_query_has_sql():
    assert set(ENTRIES) <= set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1
