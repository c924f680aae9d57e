"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import parity
import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return parity.connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(registry._QUERIES) == set(registry.ORACLES)
    assert set(registry.ORACLES) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", list(registry._QUERIES))
def test_same_rows(spark, connection, name):
    df = registry.queries()[name](spark, FOLDER)
    assert parity.differences(df, connection, registry.oracle_sql()[name]) == []


def test_entry(spark):
    assert registry.entry(spark).count() == 35
