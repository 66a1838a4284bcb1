"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import re

import pytest

import __spark_entry__ as registry
from checks.compare import compare, duck
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    apart = {n for n in registry.queries() if re.match(r"op\d+_|pipeline$", n)}  # not of this package
    assert set(registry.oracle_sql()) - apart == set(registry.queries()) - apart


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SMALL)
    assert ok, note


def test_entry(spark):
    assert registry.entry(spark).count() == 25
