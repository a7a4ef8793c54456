"""Every registered query against its SQL on DuckDB."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from medalith.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["commune_label", "departement_code", "loyer_predicted_m2"]
