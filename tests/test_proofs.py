"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from proofs.check import connect, difference

SF_DIR = os.environ.get("PROOF_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    assert difference(spark, oracle, SF_DIR, name, QUERIES[name], ORACLE.get(name)) is None


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0
