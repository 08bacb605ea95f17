"""Every registered query against DuckDB."""

import os

import pytest
from check import assert_same, connect

import __spark_entry__ as contract
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
