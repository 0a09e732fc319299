"""Every registered query against its SQL in a second engine."""

import pytest
from compare import differences

import __spark_entry__ as entry

from kvloom.oracle import oracle_queries
from kvloom.registry import registered

QUERIES, SQL = registered(), oracle_queries()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    if name in SQL:
        assert differences(spark, sf_dir, QUERIES[name], SQL[name]) == []
    else:
        assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 929


def test_every_query_has_sql():
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(SQL)
    assert set(QUERIES) == set(SQL)
