"""Every registered query of the library against its SQL on whole given tables.

``ORACLE_SF_DIR`` names other tables than the smallest.
"""

import os

import pytest

import __spark_entry__ as entry
import oracle

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
OWN = {name for module in entry.MODULES for name in module.QUERIES}  # the others have tests of their own
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == QUERIES[entry.FLAGSHIP](spark, SF).columns
