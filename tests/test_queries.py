import pytest
from oracle_check import compare, tables

import __spark_entry__ as entry
from claimworks.oracle import ORACLE
from claimworks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    equal, rows, message = compare(
        spark, con, FOLDER, name, QUERIES[name], ORACLE[name]
    )
    assert equal, message
    assert rows > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 83
