"""Every query with SQL gives the same rows as that SQL (smallest tables)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    assert compare(got, con.execute(oracle_sql()[name]).df()).startswith("ok")


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
