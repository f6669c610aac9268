import pytest
from compare import compare, connect

import __spark_entry__ as spark_entry
from stagetrace.oracle import ORACLE
from stagetrace.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    ok, note = compare(spark, db, name, FOLDER)
    assert ok, note


def test_flagship(spark):
    assert spark_entry.entry(spark).count() > 0
