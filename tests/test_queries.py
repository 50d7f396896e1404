"""Every registered query against its DuckDB twin on the smallest supplied tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the supplied tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_twin(spark, duck, name):
    problem = difference(contract.queries()[name](spark, FOLDER), duck, contract.oracle_sql()[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_twin_has_rows(spark, name):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
