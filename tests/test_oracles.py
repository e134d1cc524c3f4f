"""Every registered query against its SQL statement in DuckDB."""

import pytest
from tests.conftest import SMALL

import __spark_entry__ as driver
from eventmart.plans.registry import QUERIES
from oracles import ORACLES
from tests import oracle


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert driver.queries().items() >= QUERIES.items()
    assert driver.oracle_sql().items() >= ORACLES.items()


@pytest.mark.parametrize("key", QUERIES)
def test_same_as_sql(spark, duck, key):
    assert oracle.spark_table(QUERIES[key](spark, SMALL)) == oracle.duck_table(duck, ORACLES[key])


def test_entry(spark):
    assert driver.entry(spark).columns == ["event_type", "events", "percentage"]
