"""Every catalogue query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from granary.catalogue import queries as catalogue
from compare import connect, spark_rows, sql_rows

FOLDER = os.environ.get("GRANARY_TEST_TABLES", "/root/testdata/sf0.001")
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    """All of the catalogue; optional parts may register queries that SQL cannot express."""
    assert set(catalogue.all_queries()) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    assert spark_rows(QUERIES[name](spark, FOLDER)) == sql_rows(con, ORACLE[name])


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "project", "name", "downloads_per_project", "data_download_size",
        "number_of_unique_users_downloaded",
    ]
    assert df.count() > 0
