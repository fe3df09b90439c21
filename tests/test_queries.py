"""Every registered query against its SQL, over whole tables."""

from __future__ import annotations

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from compare import database, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    assert differences(df, con, sql) == [] if sql else df.count() > 0


def test_entry(spark):
    assert entry(spark).count() == 5
