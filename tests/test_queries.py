"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, connect
from verdure.workload.oracle import SQL
from verdure.workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name)
    assert ok, note


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1
