"""Every registered query with SQL gives what the SQL gives."""

import oracle
import pytest

from camlytics import plans

QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def db(tiny):
    return oracle.connect(tiny)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, db, tiny, name):
    assert oracle.compare(spark, db, tiny, name, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, tiny, name):
    assert QUERIES[name](spark, tiny).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert QUERIES.keys() <= e.queries().keys() and SQL.items() <= e.oracle_sql().items()
