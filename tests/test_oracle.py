"""Every query against its SQL counterpart over the same tables."""

import pytest
from compare import connect, differences
from conftest import DATA

import __spark_entry__ as driver
from workload.oracle import ORACLES
from workload.queries import QUERIES

SF_DIR = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as connection:
        yield connection


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_entry(spark):
    result = driver.entry(spark)
    assert len(result.columns) == 34
    assert result.count() == result.select("num_poliza", "num_version").distinct().count() > 0
