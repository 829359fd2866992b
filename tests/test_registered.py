"""Every registered query equals its SQL on the smallest sample."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

SF_DIR = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Queries that SQL cannot express; tests of their own hold them against brute force.
NO_SQL = {
    "op1_substring_dedup",
    "op3_toxicity",
    "op5_language_id",
    "op6_secret_scan",
    "op7_simhash_dedup",
    "op9_lm_scoring",
    "op10_source_mixing",
    "op12_whitening",
    "pipeline",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) - NO_SQL == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
