"""Every registered query against its SQL."""

import pytest
from oracle import DATA, connect, differences

import __spark_entry__ as entry
from liftworks.plans.registry import ORACLES, QUERIES

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert differences(got, duck.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_registry():
    assert set(ORACLES) == set(QUERIES)  # every query has its SQL
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
