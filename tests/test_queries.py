import pytest
from compare import duck, duck_rows, spark_rows

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duck(SF)
    yield connection
    connection.close()


def test_entry_gives_rows(spark):
    assert not entry(spark).isEmpty()


def test_sql_only_for_registered_queries():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, database, name):
    assert spark_rows(queries()[name](spark, SF)) == duck_rows(database, oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert not queries()[name](spark, SF).isEmpty()
