"""Every registered query against an independent SQL engine, values and types equal."""

import os

import pytest

import __spark_entry__ as contract
from check import compare, oracle_connection

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_sql_text_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["product", "control_pct", "treatment_pct", "lift_pp"]
