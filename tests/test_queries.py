"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import differences, duck
from webtab.oracle import ORACLE
from webtab.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


OWN = sorted(QUERIES)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@needs_tables
@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    assert differences(spark, con, name, queries()[name], oracle_sql()[name], FOLDER) is None


@needs_tables
def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["page_id", "judul", "url", "n_links"] and df.count() > 0
