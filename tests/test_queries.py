import pytest

from lakeferry.queries import ORACLES, QUERIES


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) and len(QUERIES) >= 90


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_are_those_of_the_sql(name, spark, sf, same):
    same(QUERIES[name](spark, sf), ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
