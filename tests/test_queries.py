"""Every registered query against its oracle SQL in DuckDB."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tidegate.plans import registry
from oracle import TESTDATA, compare, connect

SF_DIR = f"{TESTDATA}/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
