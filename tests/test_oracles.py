import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, connect


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_its_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) == ""


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
